"""Registries: passes bound by parameter name, plug-ins of domains, kinds with a fingerprint, extractors.

A pass is a function whose parameters are named after what it takes (``pages``, ``text``, ``raw_bytes``,
``doc_id``). A pass that cannot be found or bound is a defect of the contract and raises; what a pass
raises on a document is a result.
"""

from __future__ import annotations

import hashlib
import inspect
import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

VOCABULARY = ("pages", "text", "raw_bytes", "doc_id")


class ContractError(Exception):
    """A pass is missing, ambiguous or cannot be bound."""


@dataclass
class Passes:
    """Named passes; names with ``::`` belong to an external model and are not run here."""

    known: dict[str, Callable] = field(default_factory=dict)
    declared: set[str] = field(default_factory=set)

    def register(self, name: str, fn: Callable | None = None) -> None:
        """Register a pass, or declare one that is not built yet."""
        if fn is None:
            self.declared.add(name)
            return
        if inspect.isclass(fn):
            raise ContractError(f"{name} is a class")
        odd = [p.name for p in inspect.signature(fn).parameters.values() if p.name not in VOCABULARY and p.default is p.empty]
        if odd:
            raise ContractError(f"{name} takes {odd}, which nothing supplies")
        if name in self.known:
            raise ContractError(f"{name} is registered twice")
        self.known[name] = fn

    def run(self, name: str, **given) -> tuple[str, object]:
        """(status, result): ok, refused with a message, unbuilt, or external."""
        if "::" in name:
            return "external", None
        if name not in self.known:
            if name in self.declared:
                return "unbuilt", None
            raise ContractError(f"no pass {name}")
        fn = self.known[name]
        try:
            return "ok", fn(**{p: given.get(p) for p in inspect.signature(fn).parameters if p in VOCABULARY})
        except Exception as e:  # noqa: BLE001 - a document's defect is a result
            return "refused", f"{type(e).__name__}: {e}"


class Plugin(Protocol):
    """What a domain supplies: DataFrames in, DataFrames out."""

    def augment(self, elements: DataFrame) -> DataFrame: ...

    def to_edges(self, nodes: DataFrame) -> DataFrame: ...

    def roll_up(self, edges: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class Kind:
    """A row of the kind registry."""

    value: str
    kind: str
    domain: str
    passes: tuple[str, ...] = ()
    suffixes: tuple[str, ...] = ()


def fingerprint(kinds: Iterable[Kind]) -> str:
    """A hash of the registry that does not depend on its order."""
    rows = sorted(json.dumps(k.__dict__, sort_keys=True) for k in kinds)
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


def gate(kinds: Iterable[Kind], domain: str) -> str:
    """A pattern of the object names a domain accepts, from its kinds' suffixes."""
    ends = sorted({s.lstrip(".") for k in kinds if k.domain == domain for s in k.suffixes})
    return rf"(?i)^{domain}/.*\.({'|'.join(ends)})$" if ends else r"(?!)"


def filled(template: str, values: dict[str, str]) -> str:
    """A prompt with its ``{{name}}`` places filled; unknown ones stay."""
    for k, v in values.items():
        template = template.replace("{{" + k + "}}", v)
    return template


def extract_with(docs: DataFrame, key: str, content: str, extractor: Callable[[list], list], schema: str) -> DataFrame:
    """Rows of an external extractor (a model, OCR, embeddings): it gets a list of contents and returns, for each, a list of rows or an exception.

    The interface batches by Arrow batch, so a client can send several at once; exceptions become the
    ``reason`` of a row.
    """
    names = [c.strip().split()[0] for c in schema.split(",")]
    kind = dict(docs.dtypes)[key]

    def run(batches):
        for pdf in batches:
            rows = []
            for k, got in zip(pdf[key], extractor(pdf[content].tolist())):
                if isinstance(got, Exception):
                    rows.append((k, *[None] * len(names), f"{type(got).__name__}: {got}"))
                else:
                    rows += [(k, *r, None) for r in got]
            yield pd.DataFrame(rows, columns=[key, *names, "reason"])

    return docs.select(key, content).mapInPandas(run, f"{key} {kind}, {schema}, reason string")
