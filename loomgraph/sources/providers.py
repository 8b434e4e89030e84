"""Model providers: what answers the structured calls of the pipeline.

A provider's method returns plain Python data; `call` turns any failure into a row with
ok = false, so that no call ever fails a job, and `ask` keeps several calls in flight at
once. The offline provider is a substitute of our own, deterministic and without a model.
"""

from __future__ import annotations

import json
import os
import re
import subprocess
import time
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from itertools import islice

from ..config import Config
from ..functions.text import context_bound

PROMPTS = {
    "themes": "Name the themes of the text below as JSON {{\"themes\": [{{\"title\", \"description\", \"reasoning\"}}]}}.\n\n{text}",
    "consolidate": "The blocks below are themes found in parts of a corpus, most frequent first. Merge them into master themes and name the corpus's domain, as JSON {{\"master_domain\", \"master_themes\": [string]}}.\n\n{blocks}",
    "triples": "List the facts of the text as JSON {{\"triples\": [{{\"subject\", \"predicate\", \"object\", \"source_quote\", \"certainty_score\", \"theme_association\"}}]}}. Domain: {domain}. Themes: {themes}. Reuse these entity names where they fit: {entities}.\n\n{text}",
    "normalize": "Give each string its standard form in the domain {domain} as JSON {{\"tokens\": [{{\"original\", \"normalized\"}}]}}.\n\n{tokens}",
    "validate": "Would one name for all of these lose accuracy in the domain {domain}? Answer as JSON {{\"accuracy_destroyed\", \"condition_detected\"}}.\n\n{members}",
    "lift": "Name the common broader term of these in the domain {domain} as JSON {{\"formal_hypernym\", \"hypernym_meaning\", \"excluded_opposite\", \"members_verified\"}}. The member nearest to their centre is {center}.\n\n{members}",
    "schema": "Write a schema for this community of the domain {domain} as JSON {{\"title\", \"summary\", \"core_theme\", \"key_learnings\", \"isolated_facts\", \"protocols_code\", \"concrete_models_code\"}}. Theme inheritance: {inheritance}.\n\n{community}",
}


class OfflineProvider:
    name = "offline"
    context = 0

    def settings(self) -> dict:
        return {"provider": self.name}

    def themes(self, text: str) -> dict:
        first = next((w for w in re.split(r"\W+", text) if len(w) > 3), "")
        return {"themes": [{"title": first, "description": text, "reasoning": "first long word"}] if first else []}

    def consolidate(self, blocks: str, titles: list[str]) -> dict:
        return {"master_domain": titles[0] if titles else "", "master_themes": titles}

    def triples(self, text: str, domain: str, themes: str, entities: list[str]) -> dict:
        out = []
        for sentence in re.split(r"[.\n]", text):
            w = sentence.split()
            if len(w) >= 3:
                out.append({"subject": w[0], "predicate": w[1], "object": w[-1], "source_quote": sentence.strip(), "certainty_score": 1.0})
        return {"triples": out}

    def normalize(self, tokens: list[str], domain: str) -> dict:
        return {"tokens": [{"original": t, "normalized": t} for t in tokens]}

    def validate(self, members: list[str], domain: str) -> dict:
        return {"accuracy_destroyed": False, "condition_detected": ""}

    def lift(self, members: list[str], domain: str, center: str) -> dict:
        return {"formal_hypernym": "", "hypernym_meaning": "", "excluded_opposite": "", "members_verified": False}

    def schema(self, community: dict, domain: str, inheritance: str) -> dict:
        nodes, edges = community["nodes"], community["edges"]
        return {"title": f"Schema of {nodes[0]}", "summary": f"{len(nodes)} entities, {len(edges)} relations in {domain}", "core_theme": domain, "key_learnings": edges, "isolated_facts": [], "protocols_code": None, "concrete_models_code": None}


@dataclass
class HttpProvider:
    """An endpoint that speaks the common chat-completions format. Sampling is deterministic by default; context is told to servers that take it."""

    url: str
    model: str
    key: str = ""
    timeout: float = 120.0
    retries: int = 3
    temperature: float = 0.0
    context: int = 0
    wait: float = 1.0
    name = "http"

    def settings(self) -> dict:
        """What decides the answers; keys, and how long and how often to try, are no part of it."""
        return {k: v for k, v in asdict(self).items() if k not in ("key", "credentials", "timeout", "retries", "wait")} | {"provider": self.name}

    def address(self) -> str:
        """The url itself, or the completions below it if it ends with a version."""
        return self.url.rstrip("/") + "/chat/completions" if re.search(r"/v\d+/?$", self.url) else self.url

    def body(self, prompt: str) -> dict:
        told = {"options": {"num_ctx": self.context}} if self.context else {}
        return {"model": self.model, "messages": [{"role": "user", "content": prompt or ""}], "temperature": self.temperature, **told}

    def content(self, answer: dict) -> str:
        return answer["choices"][0]["message"]["content"] or ""

    def headers(self) -> dict[str, str]:
        return {"Content-Type": "application/json", **({"Authorization": f"Bearer {self.key}"} if self.key else {})}

    def _ask(self, prompt: str) -> dict:
        data = json.dumps(self.body(prompt)).encode()
        for attempt in range(self.retries):
            try:
                with urllib.request.urlopen(urllib.request.Request(self.address(), data, self.headers()), timeout=self.timeout) as answer:
                    return json.loads(answer_json(self.content(json.load(answer))))
            except Exception:
                if attempt + 1 == self.retries:
                    raise
                time.sleep(self.wait * 2**attempt)
        raise RuntimeError("no attempt was allowed")

    def themes(self, text: str) -> dict:
        return self._ask(PROMPTS["themes"].format(text=text))

    def consolidate(self, blocks: str, titles: list[str]) -> dict:
        return self._ask(PROMPTS["consolidate"].format(blocks=blocks))

    def triples(self, text: str, domain: str, themes: str, entities: list[str]) -> dict:
        return self._ask(PROMPTS["triples"].format(text=text, domain=domain, themes=themes, entities=json.dumps(entities, ensure_ascii=False)))

    def normalize(self, tokens: list[str], domain: str) -> dict:
        return self._ask(PROMPTS["normalize"].format(tokens=json.dumps(tokens, ensure_ascii=False), domain=domain))

    def validate(self, members: list[str], domain: str) -> dict:
        return self._ask(PROMPTS["validate"].format(members=json.dumps(members, ensure_ascii=False), domain=domain))

    def lift(self, members: list[str], domain: str, center: str) -> dict:
        return self._ask(PROMPTS["lift"].format(members=json.dumps(members, ensure_ascii=False), domain=domain, center=json.dumps(center, ensure_ascii=False)))

    def schema(self, community: dict, domain: str, inheritance: str) -> dict:
        return self._ask(PROMPTS["schema"].format(community=json.dumps(community, ensure_ascii=False), domain=domain, inheritance=inheritance))


@dataclass
class PredictProvider(HttpProvider):
    """A public endpoint that takes instances and parameters and answers with predictions. The token is the key, if one is given, or that of the environment variable `token_variable`, or else what the service account in the file `credentials` gets."""

    max_tokens: int = 8192
    temperature: float = 0.1
    token_variable: str = "ENDPOINT_TOKEN"
    credentials: str = ""
    name = "predict"

    def body(self, prompt: str) -> dict:
        return {"instances": [{"prompt": prompt or "", "max_tokens": self.max_tokens}], "parameters": {"temperature": self.temperature, "maxOutputTokens": self.max_tokens}}

    def content(self, answer: dict) -> str:
        found = answer.get("predictions") or [""]
        return found[0] if isinstance(found[0], str) else str(found[0])

    def headers(self) -> dict[str, str]:
        token = self.key or os.environ.get(self.token_variable, "")
        if not token and (path := self.credentials or os.environ.get("GOOGLE_APPLICATION_CREDENTIALS", "")):
            token = service_token(path)
        return {"Content-Type": "application/json", **({"Authorization": f"Bearer {token}"} if token else {})}


_accounts: dict[str, object] = {}


def service_token(path: str) -> str:
    """The current token of a service-account file; a worker renews it when it has run out. It needs the google-auth library; where that is absent the call fails and says so."""
    from google.auth.transport.requests import Request
    from google.oauth2 import service_account

    account = _accounts.get(path)
    if account is None:
        account = _accounts[path] = service_account.Credentials.from_service_account_file(path, scopes=["https://www.googleapis.com/auth/cloud-platform"])
    if not account.valid:
        account.refresh(Request())
    return account.token


def free_memory() -> float:
    """Free memory in MB of the graphics card with the least of it, on the driver's machine; 0 where there is none to ask."""
    try:
        told = subprocess.run(["nvidia-smi", "--query-gpu=memory.free", "--format=csv,noheader,nounits"], capture_output=True, text=True, timeout=10, check=True)
        return min(float(x) for x in told.stdout.split())
    except (OSError, subprocess.SubprocessError, ValueError):
        return 0.0


def predict_url(project: str, location: str, endpoint: str, host: str = "") -> str:
    """The address of a deployed endpoint: on its own host, where the endpoint has one, else on its location's."""
    host = host.removeprefix("https://").removeprefix("http://").split("/")[0] or f"{location}-aiplatform.googleapis.com"
    return f"https://{host}/v1/projects/{project}/locations/{location}/endpoints/{endpoint}:predict"


def make_provider(config: Config, free_mb: float = 0.0):
    """The provider that the settings name. For a local server, little free memory bounds the context."""
    if config.provider == "offline":
        return OfflineProvider()
    if config.provider == "predict":
        url = config.base_url if config.base_url.endswith(":predict") else predict_url(config.project, config.location, config.endpoint, config.base_url)
        return PredictProvider(url, config.model, timeout=120.0, wait=config.retry_wait, credentials=config.credentials)
    return HttpProvider(config.base_url, config.model, key=config.api_key, timeout=200.0, context=context_bound(free_mb, config.context), wait=config.retry_wait)


def answer_json(content: str) -> str:
    """As json_in_answer: of what follows the last output mark a fenced block, else what is between the outer braces, else all."""
    rest = content.rpartition("Output:\n")[2]
    m = re.search(r"```(?:json)?\s*(\{.*?\})\s*```", rest, re.S) or re.search(r"(\{.*\})", rest, re.S)
    return m[1] if m else rest


def call(method: Callable, *args) -> tuple[bool, str | None, str | None]:
    """(ok, payload, error) of a structured call; never raises."""
    try:
        return True, json.dumps(method(*args), ensure_ascii=False), None
    except Exception as e:  # the contract of structured calls: errors become rows
        return False, None, f"{type(e).__name__}: {e}"


def ask(method: Callable, arguments: Iterable[tuple], at_once: int) -> Iterator[tuple[bool, str | None, str | None]]:
    """The answers to many calls, in order, with at most `at_once` of them in flight in this task."""
    waiting = iter(arguments)
    if at_once <= 1:
        for args in waiting:
            yield call(method, *args)
        return
    with ThreadPoolExecutor(at_once) as pool:
        while block := list(islice(waiting, 16 * at_once)):
            yield from pool.map(lambda args: call(method, *args), block)
