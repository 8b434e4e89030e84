"""Sinks: stage tables, JSON, generated code, graph pages, run log."""

from __future__ import annotations

import html
import json
import logging
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import node_size

#: Colours of communities.
PALETTE = ("#4e79a7", "#f28e2b", "#e15759", "#76b7b2", "#59a14f", "#edc948", "#b07aa1", "#ff9da7", "#9c755f", "#bab0ac")
#: Colours of the hypergraph's communities, the twenty of a common qualitative map.
TWENTY = ("#1f77b4", "#aec7e8", "#ff7f0e", "#ffbb78", "#2ca02c", "#98df8a", "#d62728", "#ff9896", "#9467bd", "#c5b0d5", "#8c564b", "#c49c94", "#e377c2", "#f7b6d2", "#7f7f7f", "#c7c7c7", "#bcbd22", "#dbdb8d", "#17becf", "#9edae5")


def logger(name: str = "loomgraph") -> logging.Logger:
    log = logging.getLogger(name)
    if not log.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(logging.Formatter("%(asctime)s | %(levelname)s | %(name)s | %(message)s"))
        log.addHandler(handler)
        log.setLevel(logging.INFO)
    return log


def write_stage(df: DataFrame, folder: str, name: str, form: str = "parquet") -> DataFrame:
    """Write a stage as a table and read it back from there."""
    df.write.mode("overwrite").format(form).save(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).format(form).load(f"{folder}/{name}")


def write_json(rows: Iterable, path: Path) -> None:
    """A small result as one JSON file; sets become sorted lists, other values strings."""
    plain = lambda x: sorted(x) if isinstance(x, set) else x.asDict(recursive=True) if hasattr(x, "asDict") else str(x)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps([r.asDict(recursive=True) if hasattr(r, "asDict") else r for r in rows], ensure_ascii=False, indent=2, default=plain), encoding="utf-8")


def write_schemas(schemas: list[dict], domain: str, folder: Path) -> Path:
    """The generated schemas as JSON, and as a Python module where any has code."""
    write_json([{"master_domain": domain, "schemas": schemas}], folder / "schemas.json")
    code = [s[k] for s in schemas for k in ("protocols_code", "concrete_models_code") if s.get(k)]
    if code:
        (folder / "schemas.py").write_text("\n\n".join(["from __future__ import annotations\n\nfrom typing import Protocol", *code]) + "\n", encoding="utf-8")
    return folder / "schemas.json"


def community_nodes(degree: DataFrame, partition: DataFrame) -> DataFrame:
    """node, community, color, size for a drawing."""
    palette = F.array(*map(F.lit, PALETTE))
    color = F.element_at(palette, (F.pmod(F.col("community"), F.lit(len(PALETTE))) + 1).cast("int"))
    return partition.join(degree, "node", "left").select("node", "community", color.alias("color"), node_size(F.coalesce("degree", F.lit(0))).alias("size"))


def edge_labels(edges: DataFrame) -> DataFrame:
    joined = F.array_join("predicates", " | ")
    return edges.select("src", "dst", "weight", F.when(joined != "", joined).otherwise(F.coalesce("predicate", F.lit("associates"))).alias("label"))


def role_nodes(triples: DataFrame, degree: DataFrame) -> DataFrame:
    """node, role, color, size for a drawing of the triples: a node is coloured by the role it has first, subjects before objects of one triple."""
    cells = F.array(*(F.struct(F.lit(i).alias("pos"), F.lit(r).alias("role"), F.col(r).alias("node")) for i, r in enumerate(("subject", "object"))))
    seen = triples.select("ord", F.explode(cells).alias("c")).where("c.node <> ''").groupBy(F.col("c.node").alias("node"))
    first = seen.agg(F.min_by("c.role", F.struct("ord", "c.pos")).alias("role"))
    color = F.when(F.col("role") == "subject", F.lit(PALETTE[0])).otherwise(F.lit(PALETTE[1]))
    return first.join(degree, "node", "left").select("node", "role", color.alias("color"), node_size(F.coalesce("degree", F.lit(0))).alias("size"))


def hypergraph_nodes(communities: DataFrame, centrality: DataFrame, predicates: DataFrame) -> DataFrame:
    """node, kind, community, color, shape, size, title for a drawing of the bipartite graph: themes as boxes, entities as dots, larger with their centrality. communities(kind, label, community), centrality(kind, label, centrality), predicates(theme, predicate, ...)."""
    color = F.element_at(F.array(*map(F.lit, TWENTY)), (F.pmod(F.col("community"), F.lit(len(TWENTY))) + 1).cast("int"))
    told = predicates.where("predicate <> ''").groupBy(F.lit("theme").alias("kind"), F.col("theme").alias("label")).agg(F.array_join(F.array_sort(F.collect_set("predicate")), ", ").alias("said"))
    rows = communities.join(centrality, ["kind", "label"], "left").join(told, ["kind", "label"], "left")
    theme = F.col("kind") == "theme"
    size = F.coalesce("centrality", F.lit(0.0)) * 200 + F.when(theme, 35).otherwise(15)
    title = F.concat(F.when(theme, F.lit("Theme")).otherwise(F.lit("Entity")), F.lit(", community "), F.col("community").cast("string"), F.when(theme, F.concat(F.lit(", predicates: "), F.coalesce("said", F.lit("")))).otherwise(F.lit("")))
    return rows.select(F.concat_ws(":", "kind", "label").alias("node"), "kind", "community", color.alias("color"), F.when(theme, F.lit("box")).otherwise(F.lit("dot")).alias("shape"), size.alias("size"), title.alias("title"))


def hypergraph_links(members: DataFrame) -> DataFrame:
    return members.select(F.concat(F.lit("entity:"), F.col("entity")).alias("src"), F.concat(F.lit("theme:"), F.col("theme")).alias("dst"), F.lit(1.0).alias("weight"), F.lit("").alias("label"))


_DRAW = """const g=JSON.parse(document.getElementById('graph').textContent),c=document.getElementById('c'),x=c.getContext('2d'),p={};
g.nodes.forEach((n,i)=>{const a=2.39996*i,r=12*Math.sqrt(i+1);p[n.node]={n:n,x:c.width/2+r*Math.cos(a),y:c.height/2+r*Math.sin(a)}});
for(let t=0;t<200;t++){const v=Object.values(p);for(const a of v){let fx=(c.width/2-a.x)*.002,fy=(c.height/2-a.y)*.002;
if(v.length<600)for(const b of v){const dx=a.x-b.x,dy=a.y-b.y,d=dx*dx+dy*dy+1;fx+=400*dx/d;fy+=400*dy/d}a.fx=fx;a.fy=fy}
for(const e of g.edges){const a=p[e.src],b=p[e.dst];if(!a||!b)continue;const dx=(b.x-a.x)*.01,dy=(b.y-a.y)*.01;a.fx+=dx;a.fy+=dy;b.fx-=dx;b.fy-=dy}
for(const a of v){a.x+=Math.max(-9,Math.min(9,a.fx));a.y+=Math.max(-9,Math.min(9,a.fy))}}
x.strokeStyle='#bbb';x.font='11px sans-serif';for(const e of g.edges){const a=p[e.src],b=p[e.dst];if(!a||!b)continue;x.beginPath();x.moveTo(a.x,a.y);x.lineTo(b.x,b.y);x.stroke();x.fillStyle='#888';x.fillText(e.label||'',(a.x+b.x)/2,(a.y+b.y)/2)}
for(const a of Object.values(p)){x.fillStyle=a.n.color||'#4e79a7';const s=(a.n.size||15)/4;if(a.n.shape=='box')x.fillRect(a.x-s,a.y-s,2*s,2*s);else{x.beginPath();x.arc(a.x,a.y,s,0,7);x.fill()}x.fillStyle='#222';x.fillText(a.n.node,a.x+6,a.y-6)}
c.onmousemove=e=>{const m=Object.values(p).find(a=>Math.hypot(a.x-e.offsetX,a.y-e.offsetY)<9);c.title=m?(m.n.title||m.n.node):''}"""


def graph_page(nodes: Iterable, links: Iterable, path: Path, title: str) -> Path:
    """A page that draws a small graph: nodes (node, color, size, ...), links (src, dst, label, ...). It holds the data as JSON and needs nothing from elsewhere; tables follow the drawing."""
    nodes, links = [n.asDict() for n in nodes], [e.asDict() for e in links]
    row = lambda d: "<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in d.values()) + "</tr>"
    data = json.dumps({"nodes": nodes, "edges": links}, ensure_ascii=False, default=str).replace("</", "<\\/")
    path.parent.mkdir(parents=True, exist_ok=True)
    head = f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><canvas id=c width=1400 height=1000></canvas>"
    path.write_text(f"{head}<table>{''.join(map(row, nodes))}</table><table>{''.join(map(row, links))}</table><script type=application/json id=graph>{data}</script><script>{_DRAW}</script>", encoding="utf-8")
    return path


def run_log(metrics: dict, path: Path) -> Path:
    """The run's metrics as a Markdown table."""
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = ["# Run", "", "| metric | value |", "|---|---|", *(f"| {k} | {v} |" for k, v in metrics.items())]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return path
