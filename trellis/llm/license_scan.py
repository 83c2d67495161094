"""Licence scan: text units against licence templates by Dice over word bigrams.

Units are the lines of a text and its blocks (runs of lines between blank lines) of several
lines.  A unit is normalised (ASCII lower case, everything but a-z and 0-9 is a space) and
becomes its set of word bigrams.  The Dice coefficient 2|A and B| / (|A| + |B|) can reach
``t`` only if |A| lies between t/(2-t) |B| and (2-t)/t |B|: a unit outside the bounds of all
templates is dropped at once, a template outside the bounds of a unit is never scored.  The
best template of a unit wins, ties go to the smaller name.

The templates are a parameter (a small list of names and texts) and travel with the code.

Lines and blocks miss a licence of several paragraphs, a notice inside a longer line and a
wrapped header that code follows.  ``scan_passages`` has every run of consecutive words as a
unit, up to (2-t)/t times the words of a template, the whole text among them, and the full
licence texts in ``licenses/`` as templates beside the notices.  A text that lacks t/(2-t) of
a template's bigrams is dropped for this template at once.  In the others each word that
starts a shared bigram gets its best passage: the most shared bigrams less those that only one
side has.  Of passages that overlap, also of different templates, the best in this sense stays.

Defined results: a null or empty text has no units; units under two words have no bigrams and
match nothing; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from trellis.llm.common import register, table
from trellis.llm.word_hash import chunks, shingle_hashes, word_hashes

DICE = 0.8

# Short licence notices as they are commonly written.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                         "in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                      "General Public License as published by the Free Software Foundation, either version 3 of the "
                      "License, or (at your option) any later version.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

_OTHER = re.compile("[^a-z0-9]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_BLANK = re.compile(r"\n[ \t\r]*\n")


def bigrams(text: str) -> set[str]:
    w = _OTHER.sub(" ", text.translate(_LOWER)).split()
    return set(map(" ".join, zip(w, w[1:])))


class Scanner:
    """Templates by bigram, with the size bounds of each."""

    def __init__(self, templates: Mapping[str, str], dice: float):
        self.dice = dice
        self.sizes, self.by_gram = {}, {}
        for name in sorted(templates):
            grams = bigrams(templates[name])
            self.sizes[name] = len(grams)
            for g in grams:
                self.by_gram.setdefault(g, []).append(name)
        self.fewest = min(self.sizes.values()) * dice / (2 - dice)
        self.most = max(self.sizes.values()) * (2 - dice) / dice

    def best(self, unit: str) -> tuple[str, float] | None:
        """Best template of one unit."""
        if len(unit) < 2 * self.fewest:  # too short for so many words
            return None
        grams = bigrams(unit)
        if not self.fewest <= len(grams) <= self.most:
            return None
        shared: dict[str, int] = {}
        for g in grams:
            for name in self.by_gram.get(g, ()):
                shared[name] = shared.get(name, 0) + 1
        found = None
        for name in sorted(shared):
            a, b = len(grams), self.sizes[name]
            if not b * self.dice <= a * (2 - self.dice) or not a * self.dice <= b * (2 - self.dice):
                continue
            score = 2.0 * shared[name] / (a + b)
            if score >= self.dice and (found is None or score > found[1]):
                found = (name, score)
        return found

    def scan(self, text: str) -> list[tuple[str, int, str, float]]:
        """(kind of unit, its number, template, Dice) of the matching units of a text."""
        out = []
        for kind, units in (("line", text.split("\n")), ("block", _BLANK.split(text))):
            for n, unit in enumerate(units):
                if (kind == "line" or "\n" in unit.strip("\n")) and (hit := self.best(unit)):
                    out.append((kind, n, *hit))
        return out


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, dice: float = DICE) -> DataFrame:
    """doc_id, unit, unit_no, license, dice for each matching unit of ``text``."""
    templates = dict(templates)
    schema = pa.schema([("unit", pa.string()), ("unit_no", pa.int64()), ("license", pa.string()), ("dice", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, dice)
        for b in batches:
            rows, hits = [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                for hit in scanner.scan(text or ""):
                    rows.append(i)
                    hits.append(hit)
            ids = b.column("doc_id").take(pa.array(rows, pa.int64()))
            cols = [pa.array([h[k] for h in hits], f.type) for k, f in enumerate(schema)]
            yield pa.RecordBatch.from_arrays([ids, *cols], names=["doc_id", *schema.names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, unit string, unit_no long, license string, dice double")


# -- passages ----------------------------------------------------------------------------

_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def full_texts() -> dict[str, str]:
    """The licence texts that come with the code, by name with ``-text`` behind it."""
    return {f"{p.stem}-text": p.read_text() for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}


def bigram_hashes(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word bigram in order, start of each text in it)."""
    return shingle_hashes(*word_hashes([t.translate(_BYTES) for t in run]), 2, short_whole=False)


class PassageScanner:
    """Template bigrams as hashes."""

    def __init__(self, templates: Mapping[str, str], dice: float):
        self.dice = dice
        self.names = sorted(n for n in templates if bigrams(templates[n]))
        seqs = [bigram_hashes([templates[n].encode("utf-8", "surrogatepass")])[0] for n in self.names]
        self.grams = [np.unique(s) for s in seqs]
        self.sizes = np.array([len(g) for g in self.grams], np.int64)
        self.longest = [int((len(s) + 1) * (2 - dice) / dice + 1e-9) - 1 for s in seqs]      # bigrams of a passage
        owner = np.repeat(np.arange(len(seqs)), self.sizes)
        every = np.concatenate([np.zeros(0, np.uint64), *self.grams])
        order = np.argsort(every, kind="stable")
        self.known, start = np.unique(every[order], return_index=True)
        self.owner, self.start = owner[order], np.append(start, len(every))

    def candidates(self, values: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
        """(text, template) pairs that share enough bigrams."""
        if not len(values) or not len(self.known):
            return []
        place = np.minimum(np.searchsorted(self.known, values), len(self.known) - 1)
        pos = np.flatnonzero(self.known[place] == values)
        text = np.searchsorted(bounds, pos, side="right") - 1
        text, gram = np.divmod(np.unique(text * len(self.known) + place[pos]), len(self.known))
        n = self.start[gram + 1] - self.start[gram]
        at = np.repeat(self.start[gram], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        cells, shared = np.unique(np.repeat(text, n) * len(self.names) + self.owner[at], return_counts=True)
        text, which = np.divmod(cells, len(self.names))
        enough = shared * (2 - self.dice) >= self.dice * self.sizes[which] - 1e-9
        return list(zip(text[enough].tolist(), which[enough].tolist()))

    def passages(self, values: np.ndarray, which: int) -> Iterator[tuple[int, int, int, float]]:
        """(bigrams shared less bigrams of one side only, first, last bigram, Dice) of each start's best passage."""
        size, longest = int(self.sizes[which]), self.longest[which]
        order = np.argsort(values, kind="stable")
        again = np.flatnonzero(values[order][1:] == values[order][:-1])
        before = np.full(len(values), -1, np.int64)              # place of the same bigram before
        before[order[again + 1]] = order[again]
        shared = np.isin(values, self.grams[which])
        upto = np.concatenate([[0], np.cumsum(shared)])
        starts = np.flatnonzero(shared)
        hits = upto[np.minimum(starts + longest, len(values))] - upto[starts]
        for i in starts[hits * (2 - self.dice) >= self.dice * size - 1e-9].tolist():
            new = before[i:i + longest] < i
            n, both = np.cumsum(new), np.cumsum(new & shared[i:i + longest])
            dice = 2.0 * both / (n + size)
            net = np.where(dice >= self.dice, 3 * both - n - size, 0)    # above 0 wherever Dice is reached
            j = int(net.argmax())
            if net[j] > 0:
                yield int(net[j]), i, i + j, float(dice[j])

    def scan(self, run: list[bytes]) -> list[tuple[int, int, int, str, float]]:
        """(text, first word, words, template, Dice) of the passages of a run of texts."""
        values, bounds = bigram_hashes(run)
        found: dict[int, list] = {}
        for text, which in self.candidates(values, bounds):
            mine = values[bounds[text]:bounds[text + 1]]
            found.setdefault(text, []).extend((-net, self.names[which], a, b, dice) for net, a, b, dice in self.passages(mine, which))
        out = []
        for text, hits in found.items():
            taken = np.zeros(bounds[text + 1] - bounds[text] + 1, bool)
            for _, name, a, b, dice in sorted(hits):
                if not taken[a:b + 2].any():
                    taken[a:b + 2] = True
                    out.append((text, a, b + 2 - a, name, dice))
        return sorted(out)


def scan_passages(docs: DataFrame, templates: Mapping[str, str] | None = None, dice: float = DICE) -> DataFrame:
    """doc_id, first_word, n_words, license, dice for each passage; templates: the notices and the full texts."""
    if not 2 / 3 < dice <= 1:
        raise ValueError("passages need a Dice above 2/3")
    templates = {**TEMPLATES, **full_texts()} if templates is None else dict(templates)
    schema = pa.schema([("first_word", pa.int64()), ("n_words", pa.int64()), ("license", pa.string()), ("dice", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = PassageScanner(templates, dice)
        for b in batches:
            hits = [(first + i, *hit) for first, texts in chunks(b.column("text").to_pylist()) for i, *hit in scanner.scan(texts)]
            ids = b.column("doc_id").take(pa.array([h[0] for h in hits], pa.int64()))
            cols = [pa.array([h[k] for h in hits], f.type) for k, f in enumerate(schema, 1)]
            yield pa.RecordBatch.from_arrays([ids, *cols], names=["doc_id", *schema.names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, first_word long, n_words long, license string, dice double")


def _norm(col: str) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return (f"list_filter(string_split(regexp_replace(translate({col}, '{upper}', '{lower}'), '[^a-z0-9]+', ' ', 'g'), ' '), "
            "lambda w: w <> '')")


def _grams(col: str) -> str:
    return f"list_distinct(list_transform(range(1, len({col})), lambda i: {col}[i] || ' ' || {col}[i + 1]))"


_VALUES = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in TEMPLATES.items())
OP5_SQL = f"""
WITH t AS (SELECT license, {_norm('body')} AS w FROM (VALUES {_VALUES}) v(license, body)),
tg AS (SELECT license, {_grams('w')} AS grams FROM t),
u AS (
  SELECT doc_id, 'line' AS unit, unnest(range(len(parts))) AS unit_no, unnest(parts) AS body
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
  UNION ALL
  SELECT doc_id, unit, unit_no, body FROM (
    SELECT doc_id, 'block' AS unit, unnest(range(len(parts))) AS unit_no, unnest(parts) AS body
    FROM (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '\\n[ \\t\\r]*\\n') AS parts FROM documents))
  WHERE contains(trim(body, chr(10)), chr(10))),
uw AS (SELECT doc_id, unit, unit_no, {_norm('body')} AS w FROM u),
ug AS (SELECT doc_id, unit, unit_no, {_grams('w')} AS grams FROM uw WHERE len(w) >= 2),
ugs AS (SELECT * FROM ug WHERE len(grams) <= (SELECT max(len(grams)) FROM tg) * 2),
p AS (SELECT doc_id, unit, unit_no, license,
             2.0::DOUBLE * len(list_intersect(ugs.grams, tg.grams)) / (len(ugs.grams) + len(tg.grams)) AS dice
      FROM ugs, tg)
SELECT doc_id, unit, unit_no, license, dice
FROM p WHERE dice >= {DICE}
QUALIFY row_number() OVER (PARTITION BY doc_id, unit, unit_no ORDER BY dice DESC, license) = 1
"""


@register("op5_license_passages")
def op5_license_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices and full licence texts anywhere in all documents."""
    return scan_passages(table(spark, sf_dir, "documents"))


@register("op5_license_scan", OP5_SQL)
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    return scan_licenses(table(spark, sf_dir, "documents"))
