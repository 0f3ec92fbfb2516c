"""Operator 6: license scan as an exact set-similarity join.

Text blocks (64 words, every 32 words) are joined with license templates by
containment: a block is found if it holds at least ``THRESHOLD`` of a
template's distinct words.  Template words are ordered by their count in the
whole corpus, rarest first.  With a the least overlap wanted of a template
of n words, a matching block must hold one of the n - a + 1 rarest
(prefix filter), have a distinct words at all (length filter), and leave
enough template words after the first one found (positional filter); the
blocks that pass are compared in full.  All filters are lossless.

Plain phrases are reported wherever their words stand consecutively.

Defined cases: null text counts as empty; empty text has no words, null
places, empty labels and score 0; repeated rows and doc_ids are scanned one
by one; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.common import text_of

# Phrases of the contract, and opening sentences of public licenses.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction",
    "apache": "licensed under the apache license version 2 0 you may not use this file except in compliance with the license unless required by applicable law or agreed to in writing",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
}
THRESHOLD = 0.8
BLOCK, STRIDE = 64, 32
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    """Maximal runs without ASCII punctuation, A-Z lowered (bytes.lower does only that)."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower())


def token_counts(docs: DataFrame, templates: dict[str, str] | None = None) -> dict[bytes, int]:
    """How often each template word occurs in the corpus; as many rows as the templates have words."""
    known = sorted({w for t in (templates or TEMPLATES).values() for w in words_of(t)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, wanted = Counter(), set(known)
        for b in batches:
            for text in b.column("text"):
                total.update(filter(wanted.__contains__, words_of(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["w", "n"])

    rows = docs.select(text_of().alias("text")).mapInArrow(count, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()
    return {w: 0 for w in known} | {bytes(r.w): r.n for r in rows}


class TemplateIndex:
    """Templates with their words in global order, and an inverted index of the prefixes."""

    def __init__(self, templates: dict[str, str], counts: dict[bytes, int], threshold: float):
        self.templates, self.prefix = [], {}
        for label, text in sorted(templates.items()):
            order = sorted(set(words_of(text)), key=lambda w: (counts.get(w, 0), w))
            least = max(1, ceil(threshold * len(order) - 1e-9))
            t = len(self.templates)
            self.templates.append((label, order, least))
            for i, w in enumerate(order[: len(order) - least + 1]):
                self.prefix.setdefault(w, []).append((t, i))
        self.rare = frozenset(self.prefix)

    def match(self, words: list[bytes]) -> dict[str, float]:
        """label -> best containment over the blocks that reach the threshold."""
        if self.rare.isdisjoint(words):
            return {}
        found: dict[str, float] = {}
        last = max(0, len(words) - BLOCK + STRIDE - 1) // STRIDE
        places = [i for i, w in enumerate(words) if w in self.rare]
        blocks = sorted({b for i in places for b in range(max(0, (i - BLOCK) // STRIDE + 1), min(i // STRIDE, last) + 1)})
        for b in blocks:
            block = set(words[b * STRIDE : b * STRIDE + BLOCK])
            first: dict[int, int] = {}
            for w in block & self.rare:
                for t, i in self.prefix[w]:
                    first[t] = min(i, first.get(t, i))
            for t, i in first.items():
                label, order, least = self.templates[t]
                if len(block) < least or len(order) - i < least:
                    continue
                overlap = sum(w in block for w in order[i:])
                if overlap >= least:
                    found[label] = max(found.get(label, 0.0), overlap / len(order))
        return found


def phrase_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(start, label) wherever a phrase's words stand consecutively."""
    out = []
    for phrase, label in PHRASES.items():
        parts = phrase.encode().split()
        at = -1
        while True:
            try:
                at = words.index(parts[0], at + 1)
            except ValueError:
                break
            if words[at : at + len(parts)] == parts:
                out.append((at, label))
    return out


OUT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document.  Two passes over the text, no shuffle of it."""
    templates = templates or TEMPLATES
    index = TemplateIndex(templates, token_counts(docs, templates), threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column("text"):
                words = words_of(text.as_py())
                base = phrase_places(words)
                found = index.match(words)
                own = {label for _, label in base}
                at = [i for i, _ in base]
                rows.append(
                    {
                        "n_words": len(words), "n_base": len(base), "first_word": min(at, default=None), "last_word": max(at, default=None),
                        "base_labels": ",".join(sorted(own)), "labels": ",".join(sorted(own | set(found))),
                        "score": 1.0 if own else max(found.values(), default=0.0),
                    }
                )
            kinds = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64()}
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array([r[k] for r in rows], t) for k, t in kinds.items())], names=["doc_id", *kinds]
            )

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, OUT)


def op6_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
