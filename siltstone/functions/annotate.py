"""Annotation of texts by a pluggable model; a transparent rule baseline is included.

A model is a function from a text to a dict of tokens, lemmas, tags, names, labels. The baseline takes lower-cased words as
lemmas, knows numbers, punctuation, capitalised and other words, and calls runs of capitalised words that do not begin a
sentence names: organisations if a word is an organisation type, else persons. Real models replace it by the same interface.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import ORG_TYPES

SCHEMA = "status string, tokens array<string>, lemmas array<string>, tags array<string>, names array<string>, labels array<string>"
_WORD = re.compile(r"\w+|[^\w\s]")
_TYPES = {*ORG_TYPES, *ORG_TYPES.values()}


def baseline(text: str) -> dict:
    tokens = _WORD.findall(text)
    tags = ["Z" if not t[0].isalnum() and t[0] != "_" else "N" if t.isdigit() else "H" if t[0].isupper() else "S" for t in tokens]
    names, run, begins = [], [], True
    for token, tag in [*zip(tokens, tags), ("", "")]:
        if tag == "H" and not (begins and not run):
            run.append(token)
        elif run:
            names.append(run)
            run = []
        begins = token in (".", "!", "?")
    return {
        "status": "OK",
        "tokens": tokens,
        "lemmas": [t.lower() for t in tokens],
        "tags": tags,
        "names": [" ".join(r) for r in names],
        "labels": ["ORG" if any(w.lower() in _TYPES for w in r) else "PER" for r in names],
    }


def annotate(text: Column, model: Callable[[str], dict] = baseline, size: int = 1 << 20) -> Column:
    """A struct of annotations; a null or blank text has the status NO_TEXT, one that the model fails on ERR_MODEL.

    Annotations are many times as large as their text, so results leave in batches of texts of up to `size` characters
    together (a longer text is a batch of its own), whatever number of rows comes in.
    """

    def one(value) -> dict:
        if value is None or not value.strip():
            return {"status": "NO_TEXT"}
        try:
            return model(value)
        except ValueError:  # what a model raises on text that it can't analyse
            return {"status": "ERR_MODEL"}

    @F.arrow_udf(SCHEMA)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lists = [pa.field(n, pa.list_(pa.string())) for n in ("tokens", "lemmas", "tags", "names", "labels")]
        kind = pa.struct([pa.field("status", pa.string()), *lists])
        for texts in batches:
            for part in slices(texts, size):
                yield pa.array([one(t.as_py()) for t in part], kind)

    return run(text)


def slices(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """An array of texts in parts of up to `size` characters, at least one text each."""
    start, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(texts), 0).to_pylist()):
        if i > start and held + n > size:
            yield texts.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(texts) or not len(texts):
        yield texts.slice(start)
