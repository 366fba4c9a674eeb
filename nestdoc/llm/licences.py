"""Licence scans by a trained paragraph classifier.

Every paragraph (line) of every document is classified by a multinomial logistic regression over
hashed word 1-, 2- and 3-grams (those of the notices) into licence families and `unknown`; paragraphs of over `WINDOW`
words are read in overlapping windows of that length, so a notice within a long one is seen. Lines up to one without words are also read together, so is a
notice wrapped over them. The
regression is trained here: on notices of each family (`NOTICES`), whole, cut and set among words
of the corpus, and on paragraphs of a bounded sample of documents (`SAMPLE_DOCS`, drawn by hash)
and sentences that speak of licences without granting one (`OTHERS`) as `unknown`. A temperature fitted on
rows that were left out calibrates its probabilities. A prediction of a family counts if its
probability is `SURE` or more and a notice of that family confirms it: `CONFIRM` of the notice's
words pairs must be in the window. Of families that notices confirm the likeliest comes first; its
probability is against `unknown` and the families without a notice in the window. Then the window is
read again without the words of that notice, until no family is left, so each of several is found.
A family's notices on one line, less than `STRIDE` words apart, are one place.

Words are runs of ASCII letters and digits and of all non-ASCII characters, A-Z lowered.

Defined results: null, empty and wordless texts have no findings; repeated rows are each
reported; a null id is reported as null; an empty table gives an empty result; with no document
to learn `unknown` from, the made rows must do; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestdoc.llm._frames import quoted, table
from nestdoc.llm._recurrent import F32, Adam
from nestdoc.llm._words import ALNUM, U64, Words, chunks, ngrams, spread, utf8, words

SAMPLE_DOCS = 400
SAMPLE_CHARS = 4000
WINDOW, STRIDE = 60, 40
BITS = 16
STEPS = 80
SURE, CONFIRM = 0.5, 0.6
CHUNK_BYTES = 2 << 20

# Wordings that licences are granted by.
NOTICES = {
    "agpl": [
        "GNU Affero General Public License", "licensed under the AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-or-later",
        "AGPL-3.0", "SPDX-License-Identifier: AGPL",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0", "Apache License 2.0", "SPDX-License-Identifier: Apache-2.0",
        "you may not use this file except in compliance with the License", "Apache License", "Apache-2.0",
    ],
    "bsd": [
        "Licensed under the BSD License", "BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "BSD License", "BSD 2-Clause License", "BSD-2-Clause", "BSD-3-Clause", "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "cc-by": ["Licensed under CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC BY 4.0", "SPDX-License-Identifier: CC-BY-4.0"],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "cc0": ["CC0 1.0 Universal", "dedicated to the public domain under CC0", "waived all copyright and related rights", "CC0 1.0", "SPDX-License-Identifier: CC0-1.0"],
    "gpl": [
        "licensed under the GNU General Public License, version 3", "GNU General Public License version 2",
        "SPDX-License-Identifier: GPL-3.0-only", "under the terms of the GNU General Public License",
        "GNU General Public License", "GPL-2.0", "GPL-3.0", "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL",
    ],
    "isc": [
        "ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "SPDX-License-Identifier: ISC",
    ],
    "lgpl": ["GNU Lesser General Public License", "SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1", "LGPL-3.0", "SPDX-License-Identifier: LGPL"],
    "mit": [
        "Released under the MIT License", "Licensed under the MIT License", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "MIT License",
    ],
    "mpl-2.0": ["Mozilla Public License, Version 2.0", "SPDX-License-Identifier: MPL-2.0", "Mozilla Public License", "MPL-2.0"],
    "proprietary": ["All rights reserved. Unauthorized copying is prohibited", "Proprietary and confidential", "All rights reserved"],
    "unlicense": ["This is free and unencumbered software released into the public domain", "SPDX-License-Identifier: Unlicense"],
}
#: Sentences that speak of licences without granting one.
OTHERS = [
    "The licence of the driver was renewed last year", "a general theory of public goods", "the mit campus is in cambridge",
    "apache helicopters were seen over the city", "under the terms of the agreement", "a free copy of the software was sent to every person",
    "the public library holds a licence to lend films", "version 2 of the program was released", "he was licensed to practise medicine",
]
UNKNOWN = "unknown"
FAMILIES = (UNKNOWN, *NOTICES)


@dataclass
class Windows:
    """Windows of the paragraphs of some texts: row, first word in the row, and their n-grams."""

    row: np.ndarray
    start: np.ndarray
    words: np.ndarray
    grams: np.ndarray  # hashes, window after window, in it by length and then by place
    count: np.ndarray
    first: np.ndarray  # first word among the words of all texts
    line: np.ndarray  # line of each word of all texts
    sizes: np.ndarray | None = None  # words of each n-gram, where they are not in order of length


def _lines(data: np.ndarray, w: Words) -> np.ndarray:
    """Number of the line that every word is on."""
    breaks = np.concatenate(([0], np.cumsum(data == 0x0A)))
    return breaks[w.starts] if len(w.starts) else np.zeros(0, np.int64)


def _cut(column: pa.Array, wrapped: bool) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words of some texts, the line of each, and first words and ends of the windows: those of each
    line and, if `wrapped`, those of lines read together that hold more than one."""
    data, offsets = utf8(column)
    w = words(data, offsets, ALNUM)
    total, row, line = len(w.hashes), w.row, _lines(data, w)
    other = row[1:] != row[:-1]
    starts = [np.flatnonzero(np.append(np.ones(min(total, 1), bool), other | (line[1:] - line[:-1] > k))) for k in range(1 + wrapped)]
    begin = np.concatenate(starts)
    size = np.concatenate([np.diff(np.append(b, total)) for b in starts])
    n = np.maximum(1, -(-(size - (WINDOW - STRIDE)) // STRIDE))
    of = np.repeat(np.arange(len(begin)), n)
    at = begin[of] + (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)) * STRIDE
    end = np.minimum(at + WINDOW, (begin + size)[of])
    if wrapped and total:
        use = (of < len(starts[0])) | (line[at] != line[end - 1])
        at, end = at[use], end[use]
    return w, line, at, end


def windows(column: pa.Array, wrapped: bool = False) -> Windows:
    """All windows with all their n-grams."""
    w, line, at, end = _cut(column, wrapped)
    total, row = len(w.hashes), w.row
    parts, owner = [], []
    for k in (1, 2, 3):
        hashes, first = ngrams(w, k)
        place = np.full(total + 1, -1, np.int64)
        place[first] = np.arange(len(first))
        length = np.maximum(end - at - k + 1, 0)
        who = np.repeat(np.arange(len(at)), length)
        spot = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + at[who]
        parts.append(hashes[place[spot]] + U64(k))
        owner.append(who)
    owner_ = np.concatenate(owner) if owner else np.zeros(0, np.int64)
    order = np.argsort(owner_, kind="stable")
    grams = np.concatenate(parts)[order]
    r = row[at] if total else at
    return Windows(r, at - w.first[r] if total else at, end - at, grams, np.bincount(owner_, minlength=len(at)), at, line)


def _ids(grams: np.ndarray) -> np.ndarray:
    return (grams >> U64(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    weights: np.ndarray  # (2**BITS, families)
    bias: np.ndarray
    temperature: float
    templates: list[list[np.ndarray]]  # by family: of each notice the hashes of its word pairs and words

    @cached_property
    def support(self) -> np.ndarray:
        """Which n-gram ids have a weight or are those of a notice."""
        out = (self.weights != 0).any(axis=1)
        out[_ids(self.index[0])] = True
        return out

    @cached_property
    def index(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The hashes of all notices one after another, where each notice begins, and its family."""
        flat = [(f, t) for f, ts in enumerate(self.templates) for t in ts]
        sizes = np.array([len(t) for _, t in flat])
        return np.concatenate([t for _, t in flat]), np.cumsum(sizes) - sizes, np.array([f for f, _ in flat])

    def logits(self, w: Windows) -> np.ndarray:
        sums = np.add.reduceat(self.weights[_ids(w.grams)], np.cumsum(w.count) - w.count, axis=0) if len(w.count) else np.zeros((0, len(self.bias)), F32)
        return sums + self.bias

    def spots(self, column: pa.Array) -> Windows:
        """All windows with those of their n-grams that have a weight or are in a notice: the others
        add nothing. `words` holds each n-gram's place in its window, `count` how many each has."""
        w, line, at, end = _cut(column, wrapped=True)
        place, size, grams = [], [], []
        for k in (1, 2, 3):
            hashes, first = ngrams(w, k)
            hashes = hashes + U64(k)
            use = self.support[_ids(hashes)]
            place.append(first[use])
            size.append(np.full(int(use.sum()), k))
            grams.append(hashes[use])
        owner, member = [], []
        for p, n, base in zip(place, (1, 2, 3), np.cumsum([0, *map(len, place[:2])]), strict=True):
            low, high = np.searchsorted(p, at), np.searchsorted(p, end - n, "right")
            k, of = spread(low, np.maximum(low, high))
            member.append(k + base)
            owner.append(of)
        order = np.argsort(np.concatenate(owner), kind="stable")
        owner_, member_ = np.concatenate(owner)[order], np.concatenate(member)[order]
        place_, size_, grams_ = np.concatenate(place), np.concatenate(size), np.concatenate(grams)
        r = w.row[at] if len(w.hashes) else at
        return Windows(
            r, at - w.first[r] if len(at) else at, place_[member_] - at[owner_], grams_[member_],
            np.bincount(owner_, minlength=len(at)), at, line, size_[member_],
        )

    def findings(self, column: pa.Array) -> list[tuple[int, int, str, float, float]]:
        """(row, first word, family, probability, confirmed share) of each place of a notice."""
        w = self.spots(column)
        some = np.flatnonzero(w.count)  # the others are as unknown as the bias says
        first = np.cumsum(w.count) - w.count
        z = np.repeat(self.bias[None, :], len(w.count), axis=0).astype(np.float64)
        if len(some):
            z[some] += np.add.reduceat(self.weights[_ids(w.grams)], first[some], axis=0)
        z /= self.temperature
        z -= z.max(axis=1, keepdims=True) if len(z) else 0
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        found = []
        for k in np.flatnonzero((1 - p[:, 0] >= SURE) & (w.count > 0)).tolist():
            part = slice(first[k], first[k] + w.count[k])
            for start, end, f, sure, share in self._notices(w.grams[part], w.words[part], w.sizes[part]):
                at = int(w.start[k])
                found.append((int(w.row[k]), f, at + start, at + end, int(w.line[w.first[k] + start]), sure, share))
        places: list[tuple[int, int, int, int, int, float, float]] = []
        for x in sorted(found):
            last = places[-1] if places else None
            if last and last[:2] == x[:2] and (x[2] < last[3] or (x[4] == last[4] and x[2] - last[3] < STRIDE)):
                places[-1] = (*last[:3], max(last[3], x[3]), x[4], max(last[5], x[5]), max(last[6], x[6]))
            else:
                places.append(x)
        out, row, reach = [], -1, 0
        for x in sorted(places, key=lambda x: (x[0], x[2], -x[3], -x[5], x[1])):
            # What lies within another window's notice is that notice, cut by the end of a window.
            if x[0] != row or x[3] > reach:
                out.append((x[0], x[2], FAMILIES[x[1]], x[5], x[6]))
                row, reach = x[0], x[3]
        return out

    def _notices(self, grams: np.ndarray, at: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int, int, float, float]]:
        """(first word, end, family, probability, confirmed share) of the notices in a window, given
        by its n-grams, their places and their lengths."""
        parts, begin, family = self.index
        while len(grams):
            z = (self.weights[_ids(grams)].sum(axis=0) + self.bias).astype(np.float64) / self.temperature
            p = np.exp(z - z.max())
            hits = np.add.reduceat(np.isin(parts, grams).astype(np.int64), begin)
            shares = hits / np.diff(np.append(begin, len(parts)))
            held: dict[int, tuple[int, float, np.ndarray]] = {}
            for k in np.flatnonzero(shares >= CONFIRM).tolist():
                f, good = int(family[k]), (int(hits[k]), float(shares[k]), parts[begin[k] : np.append(begin, len(parts))[k + 1]])
                if f not in held or good[:2] > held[f][:2]:
                    held[f] = good
            if not held:
                return
            f = max(held, key=lambda f: p[f])
            sure = float(p[f] / (p.sum() - sum(p[g] for g in held if g != f)))
            if sure < SURE:
                return
            _, share, notice = held[f]
            mine = np.flatnonzero(np.isin(grams, notice))
            mine = mine[np.argsort(at[mine], kind="stable")]
            # The notice is where most of its pairs are together.
            spans = [mine[(at[mine] >= a) & (at[mine] <= a + len(notice))] for a in at[mine]]
            span = max(spans, key=lambda m: (len(np.unique(grams[m])), at[m[0]] - at[m[-1]]))
            start, end = int(at[span[0]]), int((at[span] + size[span]).max())
            yield start, end, f, sure, float(shares[family == f].max())
            rest = (at + size <= start) | (at >= end)
            grams, at, size = grams[rest], at[rest], size[rest]


def fit(paragraphs: list[str], seed: int = 0) -> Model:
    """Model of the notices against paragraphs of a corpus."""
    rng = np.random.default_rng(seed)
    templates: list[list[np.ndarray]] = [[]]
    for notices in NOTICES.values():
        w = windows(pa.array(notices, pa.large_string()))
        first = np.cumsum(w.count) - w.count
        templates.append([np.unique(w.grams[f : f + c][n : 2 * n - 1] if n > 1 else w.grams[f : f + c]) for f, c, n in zip(first, w.count, w.words, strict=True)])
    held = np.concatenate([t for ts in templates for t in ts])
    # Paragraphs of the corpus that hold most of a notice, or all of a short one, teach nothing.
    corpus = windows(pa.array(paragraphs, pa.large_string()))
    first = np.cumsum(corpus.count) - corpus.count
    near = np.add.reduceat(np.isin(corpus.grams, held), first) if len(first) else np.zeros(0)
    bad = set(corpus.row[near >= 3].tolist())
    known = np.flatnonzero(np.isin(corpus.grams, held))
    owner = np.repeat(np.arange(len(corpus.count)), corpus.count)[known]
    for t in (t for ts in templates for t in ts if len(t) < 3):
        mine = np.isin(corpus.grams[known], t)
        pairs = np.unique(np.stack((owner[mine].astype(U64), corpus.grams[known][mine])), axis=1)
        bad |= set(corpus.row[np.bincount(pairs[0].astype(np.int64), minlength=len(corpus.row)) == len(t)].tolist())
    plain = [p for k, p in enumerate(paragraphs) if k not in bad and p.strip()] or ["some words of a text"]
    vocabulary = [x for p in plain[:2000] for x in p.split()]

    def around(text: str) -> str:
        def pick(n: int) -> str:
            return " ".join(vocabulary[k] for k in rng.integers(len(vocabulary), size=n))

        return f"{pick(int(rng.integers(0, 25)))} {text} {pick(int(rng.integers(0, 25)))}"

    rows: list[tuple[str, int]] = [(p, 0) for p in plain[:3000]] + [(around(o), 0) for o in OTHERS for _ in range(8)]
    for f, notices in enumerate(NOTICES.values(), 1):
        for notice in notices:
            tokens = notice.split()
            for k in range(24):
                kept = [t for t in tokens if k < 12 or len(tokens) < 4 or rng.random() > 0.08]
                rows.append((around(" ".join(kept)) if k % 3 else " ".join(kept), f))
    order = rng.permutation(len(rows))
    rows = [rows[k] for k in order]
    w = windows(pa.array([" ".join(t.split()) for t, _ in rows], pa.large_string()))
    y = np.array([f for _, f in rows])[w.row]
    # Of a row cut into windows only those of `unknown` rows are sure to be what the row is.
    cut = np.bincount(w.row, minlength=len(rows))[w.row] > 1
    use = ~(cut & (y > 0))
    spare = (w.row % 4 == 0) & use
    learn = ~spare & use
    ids, owner = _ids(w.grams), np.repeat(np.arange(len(y)), w.count)
    model = Model(np.zeros((1 << BITS, len(FAMILIES)), F32), np.zeros(len(FAMILIES), F32), 1.0, templates)
    truth = np.eye(len(FAMILIES), dtype=F32)[y]
    adam = Adam({"w": model.weights, "b": model.bias}, 0.05)
    # The regression is sparse: only n-grams of the notices and of `OTHERS` have weights, so the
    # words that happen to stand around a notice in training mean nothing.
    said = [n for notices in NOTICES.values() for n in notices] + OTHERS
    support = np.unique(_ids(windows(pa.array(said, pa.large_string())).grams))
    mine = learn[owner] & np.isin(ids, support)
    ids_, owner_ = ids[mine], owner[mine]
    touched, short = np.unique(ids_, return_inverse=True)
    for _ in range(STEPS):
        z = model.logits(w)
        z = z - z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        d = np.where(learn[:, None], p - truth, 0).astype(F32) / F32(max(1, learn.sum()))
        g = np.zeros_like(model.weights)
        part = np.zeros((len(touched), len(FAMILIES)), F32)
        np.add.at(part, short, d[owner_])
        g[touched] = part
        g += F32(1e-6) * model.weights
        adam.step({"w": g, "b": d.sum(axis=0)})
    if spare.any():
        z = model.logits(w)[spare].astype(np.float64)
        loss = []
        for t in (temperatures := np.geomspace(0.3, 5, 40)):
            s = z / t
            s -= s.max(axis=1, keepdims=True)
            loss.append(-(s[np.arange(len(s)), y[spare]] - np.log(np.exp(s).sum(axis=1))).mean())
        model.temperature = float(temperatures[int(np.argmin(loss))])
    return model


def train(docs: DataFrame, text: str = "text", seed: int = 0) -> Model:
    """Model of a bounded sample of the documents."""
    t = quoted(text)
    at = F.lit(1) + F.floor(F.greatest(F.length(t) - SAMPLE_CHARS, F.lit(0)) * F.pmod(F.xxhash64(t), F.lit(1000)) / 1000)
    drawn = docs.where(t.isNotNull()).select(F.xxhash64(t, F.lit(seed)).alias("u"), F.substring(t, at.cast("int"), F.lit(SAMPLE_CHARS)).alias("piece"))
    # The texts of the smallest hashes, each once. Only about four times as many as are wanted
    # leave the tasks, unless copies make the distinct ones fewer.
    n = docs.where(t.isNotNull()).count()
    for share in (4 * SAMPLE_DOCS / max(n, 1), 64 * SAMPLE_DOCS / max(n, 1), 1.0):
        near = drawn if share >= 1 else drawn.where(F.col("u") < F.lit(int(-(1 << 63) + share * (1 << 64))))
        rows = near.groupBy("u").agg(F.min("piece").alias("piece")).orderBy("u").limit(SAMPLE_DOCS).collect()
        if len(rows) == SAMPLE_DOCS or share >= 1:
            break
    return fit([line for r in rows for line in r["piece"].split("\n")], seed)


def scan(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start_word, family, probability, confirmed): one row for each family and document
    and place, with the notice's first word and its surest probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.select(quoted(doc_id)).schema.fields[0].dataType),
            T.StructField("start_word", T.LongType()),
            T.StructField("family", T.StringType()),
            T.StructField("probability", T.DoubleType()),
            T.StructField("confirmed", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", CHUNK_BYTES):
            best = shared.value.findings(part.column(1))
            columns = list(zip(*best, strict=True)) if best else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(columns[0], pa.int64())), *(pa.array(c, k) for c, k in zip(columns[1:], (pa.int64(), pa.string(), pa.float64(), pa.float64()), strict=True))],
                names=[f.name for f in schema.fields],
            )

    return docs.select(quoted(doc_id).alias("doc_id"), quoted(text).cast("string").alias("text")).mapInArrow(run, schema)


def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, train(docs))
