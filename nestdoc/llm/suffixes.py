"""Repeated passages by sparse suffix arrays, and their removal.

Of all suffixes of the documents' word sequences only those at content-selected positions are
kept: in every run of `min_words` words the word group (`GROUP` words) of the least hash, the
leftmost of equal ones. Two equal runs select the same place, so a passage of `min_words` words
that repeats has a kept suffix at the same offset in each copy. The kept suffixes are sorted by
their leading words (a shuffle and sort by group hash), and those without an equal neighbour
are dropped. The others are extended left and right to every run of `min_words` words that
selects them, and the runs are compared among all their occurrences, so a repeat of any length
is found from its first word to its last. Of equal runs the first by (id, hash of text,
position) is the original; all others are repeats.

A document whose whole text an earlier one has is a copy. It is one span that points at the first
such document, and takes no further part. Words are `[^\\x20\\x09-\\x0D]+` of the text with A-Z
lowered; runs are compared by 64-bit hashes.

Defined results: null, empty and short texts (under `min_words` words) have no passages; rows
that repeat an id and its text are one document, so they are no copies of each other; a null id
comes before all others; passages that repeat within one document count; an empty table gives an
empty result; columns other than id and text are not looked at and stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestdoc.llm._frames import free_name, n_words, parted, pinned, quoted, release, sent, table
from nestdoc.llm._words import NON_SPACE, U64, Words, chunks, mix, ngrams, utf8, words

MIN_WORDS = 50
GROUP = 8
CHUNK_BYTES = 1 << 20
_PLACE = U64((1 << 24) - 1)


def anchors(w: Words, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every run of `min_words` words within a row: its first word, the place it selects, and
    the hash of the word group there."""
    total = len(w.hashes)
    hashes, at = ngrams(w, GROUP)
    key = np.full(total + min_words, ~U64(0), U64)
    key[at] = (hashes & ~_PLACE) | (at.astype(U64) & _PLACE)
    span = min_words - GROUP + 1  # groups in a run
    least, width = key, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    left = np.repeat(w.first[1:], w.counts) - np.arange(total)
    runs = np.flatnonzero(left >= min_words)
    low = (least[runs] & _PLACE).astype(np.int64)
    place = runs + ((low - runs) & int(_PLACE))
    of = np.zeros(total, U64)
    of[at] = hashes
    return runs, place, of[place]


_WORD = 0xD1342543DE82EF95
_WORD_INV = pow(_WORD, -1, 1 << 64)


def run_hashes(w: Words, runs: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` words from each of `runs`."""
    n = len(w.hashes)
    up, down = np.full(n + 1, _WORD, U64), np.full(n + 1, _WORD_INV, U64)
    up[0] = down[0] = 1
    up, down = np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)
    sums = np.concatenate((np.zeros(1, U64), np.cumsum(w.hashes * up[:n], dtype=U64)))
    return mix((sums[runs + length] - sums[runs]) * down[runs])


def _same(a: str = "id", b: str = "i") -> F.Column:
    return F.col(a).eqNullSafe(F.col(b)) & (F.col("th") == F.col("t"))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        quoted(doc_id).alias("id"), F.xxhash64(quoted(text)).alias("th"), quoted(text).cast("string").alias("text")
    )


def repeated_passages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """(id, th, first_id, start, end): words start..end of the document repeat words of the
    document `first_id`, where they come first. `th` is xxhash64 of the text. Spans that overlap
    or touch are one if they point at the same document."""
    if min_words < GROUP:
        raise ValueError(f"min_words is {min_words}; at least {GROUP} are needed")
    docs = _keyed(docs, doc_id, text)
    id_type = docs.schema["id"].dataType
    keys = pinned(docs.select("id", "th", n_words(F.col("text")).alias("n")).where(F.col("n") >= min_words).distinct())
    heads = keys.groupBy("th").agg(F.min(F.struct("id")).alias("head"), F.count("*").alias("copies")).where(F.col("copies") > 1)
    copies = keys.join(heads, "th").where(~F.col("id").eqNullSafe(F.col("head.id")))
    copies = pinned(copies.select("id", "th", F.col("head.id").alias("first_id"), F.col("n")))
    release(keys)
    taken = copies.select(F.col("id").alias("i"), F.col("th").alias("t"))
    lead = docs.join(sent(taken), _same(), "left_anti").where(F.col("text").isNotNull())

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", CHUNK_BYTES):
            w = words(*utf8(part.column(2)), NON_SPACE)
            _, place, group = anchors(w, min_words)
            place, one = np.unique(place, return_index=True)
            row, group = w.row[place], group[one]
            order = np.lexsort((group, row))
            row, group = row[order], group[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (group[1:] != group[:-1])
            times = np.diff(np.append(np.flatnonzero(new), len(row)))
            row = pa.array(row[new])
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(row), part.column(1).take(row), pa.array(group[new].view(np.int64)), pa.array(times)],
                names=["id", "th", "grp", "times"],
            )

    id_field, th_field = T.StructField("id", id_type), T.StructField("th", T.LongType())
    schema = T.StructType([id_field, th_field, T.StructField("grp", T.LongType()), T.StructField("times", T.LongType())])
    kept = lead.mapInArrow(select, schema)
    # Rows that repeat an id and its text select alike and are one document.
    kept = kept.groupBy("grp", "id", "th").agg(F.max("times").alias("times")) if _repeats(docs, min_words) else kept
    kept = pinned(kept)
    neighbours = kept.groupBy("grp").agg(F.sum("times").alias("all")).where(F.col("all") > 1).select("grp")
    met = pinned(kept.join(neighbours, "grp").groupBy("id", "th").agg(F.collect_list("grp").alias("groups")))
    release(kept)
    spots = met.select(F.col("id").alias("i"), F.col("th").alias("t"), "groups")
    some, _ = parted(lead, F.xxhash64("id", "th"), met.select(F.xxhash64("id", "th")))
    some = pinned(some.dropDuplicates(["id", "th"]).join(spots, _same()).select("id", "th", "text", "groups"))
    release(met)

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", CHUNK_BYTES):
            w = words(*utf8(part.column(2)), NON_SPACE)
            runs, _, group = anchors(w, min_words)
            row = w.row[runs]
            lists = part.column(3)
            of = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
            wanted = mix(lists.flatten().to_numpy(zero_copy_only=False).view(U64) + mix(of.astype(U64)))
            use = np.isin(mix(group + mix(row.astype(U64))), wanted)
            runs, row = runs[use], row[use]
            hashes, start = run_hashes(w, runs, min_words), runs - w.first[row]
            # One row for a document's occurrences of a run, with all their places.
            order = np.lexsort((start, hashes, row))
            row, hashes, start = row[order], hashes[order], start[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
            begin = np.flatnonzero(new)
            row_ = pa.array(row[new])
            places = pa.ListArray.from_arrays(pa.array(np.append(begin, len(row)), pa.int32()), pa.array(start))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(row_), part.column(1).take(row_), pa.array(hashes[new].view(np.int64)), places],
                names=["id", "th", "run", "starts"],
            )

    starts = T.StructField("starts", T.ArrayType(T.LongType()))
    schema = T.StructType([id_field, th_field, T.StructField("run", T.LongType()), starts])
    runs = some.mapInArrow(extend, schema)
    times = F.sum(F.size("starts")).alias("all")
    first = runs.groupBy("run").agg(F.min(F.struct("id", "th")).alias("f"), times).where(F.col("all") > 1)
    own = F.struct("id", "th").eqNullSafe(F.col("f"))
    again = F.when(own, F.expr("slice(starts, 2, size(starts))")).otherwise(F.col("starts"))
    later = runs.join(first.select("run", "f"), "run").where(~own | (F.size("starts") > 1)).select("id", "th", F.col("f.id").alias("first_id"), F.explode(again).alias("start"))
    spans = merged(later, ["id", "th", "first_id"], min_words).unionByName(
        copies.select("id", "th", "first_id", F.lit(0).cast("long").alias("start"), F.col("n").alias("end"))
    )
    spans = pinned(spans)
    release(some, copies)
    return spans


def _repeats(docs: DataFrame, min_words: int) -> bool:
    """Whether an id comes with the same text twice."""
    return bool(docs.groupBy("id", "th").count().where(F.col("count") > 1).limit(1).count())


def merged(runs: DataFrame, by: list[str], length: int) -> DataFrame:
    """Runs of `length` words from `start`, united where they overlap or touch. A window holds the
    runs of one document at most."""
    w = Window.partitionBy(*by).orderBy("start")
    new = F.coalesce((F.col("start") - F.lag("start").over(w) > length).cast("long"), F.lit(1))
    island = F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (
        runs.select(*by, "start").withColumn("island", island).groupBy(*by, "island")
        .agg(F.min("start").alias("start"), (F.max("start") + length).alias("end")).drop("island")
    )


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without the words that repeat an earlier passage: each is cut from its first
    word to the next word that stays. Documents of which no word stays go; those that had none
    stay. A column n_chars, if there is one, is counted anew where text was cut."""
    spans = repeated_passages(docs, doc_id, text, min_words)
    cuts = spans.groupBy("id", "th").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    id_, th = free_name(docs, "cut_id"), free_name(docs, "cut_th")
    out = free_name(docs, "cuts")
    cuts = pinned(cuts.select(F.col("id").alias(id_), F.col("th").alias(th), F.col("cuts").alias(out)))
    key = F.xxhash64(quoted(doc_id), F.xxhash64(quoted(text)))
    touched, others = parted(docs, key, cuts.select(F.xxhash64(id_, th)))
    met = quoted(doc_id).eqNullSafe(F.col(id_)) & (F.xxhash64(quoted(text)) == F.col(th))
    touched = touched.join(cuts, met).drop(id_, th)
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text, CHUNK_BYTES):
            at = part.schema.get_field_index(text)
            data, offsets = utf8(part.column(at))
            w = words(data, offsets, NON_SPACE)
            stays = np.ones(len(data), bool)
            left = np.zeros(part.num_rows, bool)
            for r, spans_ in enumerate(part.column(part.schema.get_field_index(out)).to_pylist()):
                low, high = w.first[r], w.first[r + 1]
                gone = np.zeros(high - low, bool)
                for s in spans_:
                    gone[s["start"] : s["end"]] = True
                    end = low + s["end"]
                    stays[w.starts[low + s["start"]] : w.starts[end] if end < high else offsets[r + 1]] = False
                left[r] = not gone.all()
            keep = np.flatnonzero(left)
            text_out = [data[offsets[r] : offsets[r + 1]][stays[offsets[r] : offsets[r + 1]]].tobytes().decode("utf-8", "replace") for r in keep]
            cols = [c.take(pa.array(keep)) for c in part.columns[: len(names)]]
            cols[at] = pa.array(text_out, part.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    clean = touched.mapInArrow(cut, T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema.fields]))
    if "n_chars" in names and "n_chars" not in (doc_id, text):
        clean = clean.withColumn("n_chars", F.length(quoted(text)).cast(docs.schema["n_chars"].dataType))
    return others.unionByName(clean)


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of 50 words or more that an earlier document, or place, has too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = repeated_passages(docs)
    return found.select(
        F.col("id").alias("doc_id"), F.col("first_id").alias("first_doc_id"), F.col("start").alias("start_word"), F.col("end").alias("end_word"),
        (F.col("end") - F.col("start")).alias("n_words"),
    )


# Ids in `documents` are distinct, so the text's hash never decides an order.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, text, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
h AS (SELECT doc_id, w, min(doc_id) OVER (PARTITION BY text) AS head FROM d WHERE len(w) >= 50),
runs AS (
  SELECT doc_id, s, md5(array_to_string(w[s + 1 : s + 50], ' ')) AS run
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS s FROM h WHERE doc_id = head)),
ranked AS (
  SELECT doc_id, s, first_value(doc_id) OVER o AS first_id, row_number() OVER o AS k
  FROM runs WINDOW o AS (PARTITION BY run ORDER BY doc_id, s)),
marked AS (
  SELECT *, coalesce(s - lag(s) OVER o > 50, true)::INT AS fresh
  FROM ranked WHERE k > 1 WINDOW o AS (PARTITION BY doc_id, first_id ORDER BY s)),
islands AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, first_id ORDER BY s) AS island FROM marked)
SELECT doc_id, first_id AS first_doc_id, min(s) AS start_word, max(s) + 50 AS end_word, max(s) + 50 - min(s) AS n_words
FROM islands GROUP BY doc_id, first_id, island
UNION ALL
SELECT doc_id, head, 0, len(w), len(w) FROM h WHERE doc_id <> head
"""
