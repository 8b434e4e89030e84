"""Knowledge graphs and ontologies from text corpora, as DataFrame plans."""
