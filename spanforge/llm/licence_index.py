"""License scans by a positional index of rare words.

A template is a passage of a licence with the key phrases that must stand in it. The index posts each template under
its key word of the highest inverse document frequency, which is counted over all documents, with the word's place in
the template. A file's licence words are looked up in it: each occurrence of a posted word says where the template would
begin; the template's next rarest key words keep only the beginnings that their own relative places agree with, until
the key phrases stand whole; then the template's other words are counted in place. As a match must hold every key word
in place, it is met through the rarest: no match is lost, and the frequencies decide the work only.

A match needs every key phrase at its place and at least COVER of the template's words in place; its share of words in
place is its score. The base phrases are templates of one key phrase.

Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case. Each file is judged by itself; the
index is of the templates' size and goes to every task; only counts of licence words are shuffled.

Defined cases: null and empty texts have no words, no labels ('') and score 0; very long texts are read whole; repeated
rows are judged alike; an empty table gives no rows; kept columns may have any name, and what is added replaces its
namesakes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm.shared import small_batches
from spanforge.llm.words import chunks

#: Characters that are no part of a word, by byte.
BREAKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: Share of a template's words that must be in place.
COVER = 0.5


class Template(NamedTuple):
    """Label, text (words in lower case) and key phrases, which occur in it; base ones are counted by place."""

    label: str
    text: str
    keys: tuple[str, ...]
    base: bool = False


#: Notices and passages of public licences, and the base phrases.
TEMPLATES = (
    Template("cc-by", "cc by", ("cc by",), True),
    Template("gpl", "general public license", ("general public license",), True),
    Template("reserved", "all rights reserved", ("all rights reserved",), True),
    Template("agpl-3.0", "licensed under the gnu affero general public license version 3", ("gnu affero general public license version 3",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("except in compliance with the license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "following conditions are met")),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-4.0", "licensed under the creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    Template("gpl-2.0", "this work is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "without fee is hereby granted")),
    Template("lgpl", "licensed under the gnu lesser general public license version", ("gnu lesser general public license",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction", ("hereby granted free of charge to any person",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)


def key_places(template: Template) -> list[int]:
    """Places of the template's words that its key phrases cover."""
    words, out = template.text.split(), set()
    for phrase in (x.split() for x in template.keys):
        at = next((k for k in range(len(words)) if words[k : k + len(phrase)] == phrase), None)
        if at is None:
            raise ValueError(f"key phrase {' '.join(phrase)!r} is not in its template")
        out.update(range(at, at + len(phrase)))
    return sorted(out)


class Index(NamedTuple):
    """hashes: of the licence words, ascending; words[t]: their numbers by place of template t; keys[t]: its key
    places, rarest word first; postings: templates by the number of their rarest key word, rarest words first."""

    templates: tuple[Template, ...]
    hashes: np.ndarray
    words: list[np.ndarray]
    keys: list[np.ndarray]
    postings: dict[int, list[int]]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words by hash; -1 where it is no licence word."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)


def _blank(templates: tuple[Template, ...]) -> tuple[list[str], Index]:
    """The licence words in the order of their hashes, and an index that takes key words as they stand."""
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    (chunk,) = chunks(pa.array([" ".join(vocabulary)]), True, space=BREAKS)
    order = np.argsort(chunk.hashes)
    number = {vocabulary[k]: n for n, k in enumerate(order)}
    keys = [np.array(key_places(t)) for t in templates]
    return [vocabulary[k] for k in order], Index(templates, chunk.hashes[order], [np.array([number[w] for w in t.text.split()]) for t in templates], keys, {})


def document_frequency(docs: DataFrame, index: Index) -> DataFrame:
    """Documents that hold each licence word, and the number of documents under word -1: word, n."""
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(sent.value.hashes) + 1, np.int64)
        for batch in batches:
            for chunk in chunks(batch.column("text"), True, space=BREAKS):
                number = sent.value.numbers(chunk.hashes)
                at = np.flatnonzero(number >= 0)
                owner = np.searchsorted(chunk.words, at, "right") - 1
                held = np.unique(owner * len(totals) + number[at]) % len(totals)
                totals[:-1] += np.bincount(held, minlength=len(totals))[:-1]
            totals[-1] += batch.num_rows
        seen = np.flatnonzero(totals)
        yield pa.record_batch({"word": pa.array(np.where(seen == len(totals) - 1, -1, seen), pa.int32()), "n": pa.array(totals[seen])})

    return docs.select("text").mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_index(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> tuple[Index, dict[str, float]]:
    """The index, its key words ordered by the inverse document frequencies over all docs, and those of all licence words."""
    words, index = _blank(templates)
    counts = {r.word: r.n for r in document_frequency(docs, index).collect()}
    idf = np.array([math.log((1 + counts.get(-1, 0)) / (1 + counts.get(k, 0))) for k in range(len(words))])
    keys = [at[np.lexsort((at, -idf[own[at]]))] for at, own in zip(index.keys, index.words, strict=True)]
    rarest = [int(own[at[0]]) for at, own in zip(keys, index.words, strict=True)]
    postings = {w: [t for t, x in enumerate(rarest) if x == w] for w in sorted(set(rarest), key=lambda w: (-idf[w], w))}
    return index._replace(keys=keys, postings=postings), dict(zip(words, idf.tolist(), strict=True))


def find(index: Index, number: np.ndarray, words: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(document, template, place of its first word in the document, share in place) of every match in a chunk, whose
    licence words are numbered (-1: another word) and whose document i has the words words[i] to words[i + 1]."""
    found = []
    held = {w: np.flatnonzero(number == w) for w in np.unique(number[number >= 0]).tolist() if w in index.postings}
    for t, at in ((t, held[w]) for w, posted in index.postings.items() if w in held for t in posted):
        own, keys = index.words[t], index.keys[t]
        owner = np.searchsorted(words, at, "right") - 1
        begin, low, high = at - keys[0], words[owner], words[owner + 1]
        for q in keys[1:]:
            p = begin + q
            inside = (p >= low) & (p < high)
            fits = inside & (number[np.where(inside, p, 0)] == own[q])
            begin, owner, low, high = begin[fits], owner[fits], low[fits], high[fits]
        if not len(begin):
            continue
        p = begin[:, None] + np.arange(len(own))
        inside = (p >= low[:, None]) & (p < high[:, None])
        share = (inside & (number[np.where(inside, p, 0)] == own)).sum(axis=1) / len(own)
        found += [(int(d), t, int(b - w), float(s)) for d, b, w, s in zip(owner, begin, low, share, strict=True) if s >= COVER]
    return found


MATCHES = "matches array<struct<label string, base boolean, first_word long, words int, share double>>"


def scan(docs: DataFrame, index: Index, keep: list[str]) -> DataFrame:
    """keep columns with n_words, matches (in order of place), n_base, first_word and last_word (of base matches),
    base_labels, labels and score."""
    sent = docs.sparkSession.sparkContext.broadcast(index)
    added = pa.list_(pa.struct({"label": pa.string(), "base": pa.bool_(), "first_word": pa.int64(), "words": pa.int32(), "share": pa.float64()}))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            matches: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            sizes = np.zeros(batch.num_rows, np.int64)
            for chunk in chunks(batch.column("text"), True, space=BREAKS):
                sizes[chunk.first : chunk.last] = np.diff(chunk.words)
                for d, t, first, share in find(index, index.numbers(chunk.hashes), chunk.words):
                    template = index.templates[t]
                    matches[chunk.first + d].append({"label": template.label, "base": template.base, "first_word": first, "words": len(index.words[t]), "share": share})
            rows = [sorted(x, key=lambda m: (m["first_word"], m["label"], m["words"])) for x in matches]
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(sizes), pa.array(rows, added)], ["kept", "n_words", "matches"])

    given = docs.select(F.struct(*keep).alias("kept"), F.col("text"))
    schema = f"kept {given.schema['kept'].dataType.simpleString()}, n_words long, {MATCHES}"
    out = given.mapInArrow(look, schema)
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["first_word"])
    labels = lambda x: F.array_join(F.array_sort(F.array_distinct(F.transform(x, lambda m: m["label"]))), ",")
    columns = {"n_words": F.col("n_words"), "n_base": F.size(base).cast("long"), "first_word": F.array_min(starts), "last_word": F.array_max(starts), "base_labels": labels(base), "labels": labels(F.col("matches")), "score": F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)), "matches": F.col("matches")}
    return out.select(*[F.col("kept")[c].alias(c) for c in keep if c not in columns], *[v.alias(k) for k, v in columns.items()])


def op12_licence_index(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    index, _ = build_index(docs)
    return scan(docs, index, ["doc_id"]).drop("matches")


def _values() -> str:
    rows = []
    for t, template in enumerate(TEMPLATES):
        words, keys = template.text.split(), set(key_places(template))
        rows += [f"({t}, '{template.label}', {str(template.base).lower()}, {len(words)}, {len(keys)}, {q}, '{w}', {str(q in keys).lower()})" for q, w in enumerate(words)]
    return ", ".join(rows)


ORACLE = rf"""WITH templates(t, label, base, n, n_keys, q, word, is_key) AS (VALUES {_values()}),
docs AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
placed AS (SELECT r, i, word FROM (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i FROM docs) WHERE word IN (SELECT word FROM templates)),
matches AS (SELECT r, t, i - q AS first, any_value(label) AS label, any_value(base) AS base, CAST(count(*) AS DOUBLE) / any_value(n) AS share
  FROM placed JOIN templates USING (word) GROUP BY r, t, i - q HAVING count(*) FILTER (is_key) = any_value(n_keys) AND count(*) >= {COVER} * any_value(n)),
told AS (SELECT r, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM matches GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM docs LEFT JOIN told USING (r)"""
