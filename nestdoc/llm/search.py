"""Ranked lexical search: a sharded inverted index, scored by a hybrid of term-at-a-time and
document-at-a-time.

`build_index` cuts the documents into shards of bounded text, each one row of a Parquet table in
the shared folder: the shard's ids, lengths, terms and posting lists (all terms of all whole
texts). Documents are never shuffled. `search` sends the queries to the shards in blocks of
bounded size, first for the document frequencies of their terms, then for their best documents.

In a shard, the short lists of a query are added up term at a time into accumulators; their sums
by document are then one more iterator, bounded by its greatest sum, beside the long lists. Of
these the ones whose bounds together stay below the k-th best score so far cannot bring a
document in on their own: documents are taken from the others, in blocks by document, and skip
forward through the rest only while their score and the remaining bounds can still reach it.
The k-th best score goes on from shard to shard within a task.

Words are `[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+` with A-Z lowered, named by 64-bit hashes.
With N documents that have a word, L words in all, n of the document, a term in df documents and
tf times in this one scores floor(1000 ln((2 N + 2) / (2 df + 1))) * (10^9 tf div (1000 tf + 8 m)),
m = 10 + (90 n N) div L; a document's score is the sum over the query's terms, once each.

Defined results: null, empty and wordless texts are in no list and never found; a query without
words finds nothing; each row of the queries is a query of its own, each row of the documents a
document; equal scores go by ascending id, null ids last; empty tables give empty results.
Other columns are not read, whatever they are called.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestdoc.llm._frames import quoted, table
from nestdoc.llm._words import ALNUM, chunks, spread, utf8, words
from nestdoc.session import scratch_path

TOP = 10
#: Bytes of text in a shard.
SHARD_BYTES = 8 << 20
#: Bytes of query text that a task looks for in one pass.
BLOCK_BYTES = 8 << 20
#: Lists of up to a shard's documents over this are short.
SHORT_SHARE = 8
#: Documents that are taken at a time.
STEP = 1024

_KINDS = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}


def _packed(a: np.ndarray) -> bytes:
    """Numbers in as few bytes each as the greatest needs."""
    most = int(a.max()) if len(a) else 0
    return a.astype(next(k for size, k in _KINDS.items() if most < 1 << (8 * size))).tobytes()


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, _KINDS[len(raw) // n]).astype(np.int64) if n else np.zeros(0, np.int64)


def _shard(ids: pa.Array, texts: pa.Array) -> dict:
    """Posting lists of some documents; places in a shard follow the ids."""
    order = pc.sort_indices(ids, null_placement="at_end")
    ids, texts = ids.take(order), texts.take(order)
    w = words(*utf8(texts), ALNUM)
    terms, code = np.unique(w.hashes, return_inverse=True)
    n = max(len(texts), 1)
    keys, counts = np.unique(code.astype(np.int64) * n + w.row, return_counts=True)
    return {
        "ids": ids,
        "n_docs": len(texts),
        "lengths": _packed(w.counts),
        "terms": terms.tobytes(),
        "sizes": _packed(np.bincount(keys // n, minlength=len(terms))),
        "n_postings": len(keys),
        "places": _packed(keys % n),
        "counts": _packed(counts),
    }


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index of `docs`, written to the shared folder: one row for each shard."""
    spark = docs.sparkSession
    docs = docs.select(quoted(doc_id).alias("id"), quoted(text).alias("text"))
    kind = docs.schema["id"].dataType
    schema = T.StructType(
        [
            T.StructField("ids", T.ArrayType(kind)),
            T.StructField("n_docs", T.LongType()),
            T.StructField("lengths", T.BinaryType()),
            T.StructField("terms", T.BinaryType()),
            T.StructField("sizes", T.BinaryType()),
            T.StructField("n_postings", T.LongType()),
            T.StructField("places", T.BinaryType()),
            T.StructField("counts", T.BinaryType()),
        ]
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", shard_bytes):
            row = _shard(part.column(0), part.column(1))
            ids = pa.ListArray.from_arrays(pa.array([0, row["n_docs"]], pa.int32()), row.pop("ids"))
            columns = [ids, *(pa.array([v], pa.int64() if isinstance(v, int) else pa.binary()) for v in row.values())]
            yield pa.RecordBatch.from_arrays(columns, names=["ids", *row])

    path = scratch_path(spark, "lexical-index")
    docs.mapInArrow(build, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@dataclass
class Queries:
    """One block of queries: their terms as places in a sorted vocabulary."""

    names: list
    vocabulary: np.ndarray
    codes: list[np.ndarray]
    weights: np.ndarray | None = None
    n_docs: int = 0
    n_words: int = 0


def _queries(rows: list[tuple]) -> Queries:
    w = words(*utf8(pa.array([text for _, text in rows], pa.large_string())), ALNUM)
    vocabulary, code = np.unique(w.hashes, return_inverse=True)
    codes = [np.unique(code[a:b]) for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
    return Queries([name for name, _ in rows], vocabulary, codes)


def _weigh(index: DataFrame, q: Queries) -> None:
    """Counts of all documents and words, and the weight of every term of the queries."""
    shared = index.sparkSession.sparkContext.broadcast(q.vocabulary)  # bounded by BLOCK_BYTES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        found = np.zeros(len(vocabulary) + 2, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                lengths = _unpacked(row["lengths"], row["n_docs"])
                found[-2:] += (lengths > 0).sum(), lengths.sum()
                terms = np.frombuffer(row["terms"], np.uint64)
                sizes = _unpacked(row["sizes"], len(terms))
                at = np.searchsorted(terms, vocabulary)
                here = np.flatnonzero(at < len(terms))
                here = here[terms[at[here]] == vocabulary[here]]
                found[here] += sizes[at[here]]
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], names=["term", "n"])

    read = index.select("n_docs", "lengths", "terms", "sizes").mapInArrow(count, "term long, n long")
    found = np.zeros(len(q.vocabulary) + 2, np.int64)
    for r in read.groupBy("term").agg(F.sum("n").alias("n")).collect():  # a row for each query term
        found[r["term"]] = r["n"]
    q.n_docs, q.n_words = int(found[-2]), int(found[-1])
    q.weights = np.array(
        [math.floor(1000 * math.log((2 * q.n_docs + 2) / (2 * int(df) + 1))) if df else 0 for df in found[:-2]], np.int64
    )


@dataclass
class Lists:
    """Posting lists of a shard for the terms of the queries, with scores."""

    n_docs: int
    list_of: np.ndarray  # for each term of the vocabulary its list here, or -1
    borders: np.ndarray
    places: np.ndarray
    scores: np.ndarray
    bounds: np.ndarray  # the greatest score of each list


def _lists(row: dict, q: Queries) -> Lists | None:
    terms = np.frombuffer(row["terms"], np.uint64)
    at = np.searchsorted(terms, q.vocabulary)
    here = np.flatnonzero((at < len(terms)) & (q.weights > 0))
    here = here[terms[at[here]] == q.vocabulary[here]]
    if not len(here):
        return None
    ends = np.cumsum(_unpacked(row["sizes"], len(terms)))
    high = ends[at[here]]
    low = np.where(at[here] > 0, ends[at[here] - 1], 0)
    members, of = spread(low, high)
    places = _unpacked(row["places"], row["n_postings"])[members]
    tf = _unpacked(row["counts"], row["n_postings"])[members]
    m = 10 + (90 * _unpacked(row["lengths"], row["n_docs"]) * q.n_docs) // q.n_words
    scores = q.weights[here][of] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[places]))
    borders = np.concatenate(([0], np.cumsum(high - low)))
    list_of = np.full(len(q.vocabulary), -1, np.int64)
    list_of[here] = np.arange(len(here))
    return Lists(row["n_docs"], list_of, borders, places, scores, np.maximum.reduceat(scores, borders[:-1]))


def best_of_shard(
    s: Lists, terms: np.ndarray, least: int, k: int, short: int, step: int = STEP
) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the up to k best documents for the lists `terms` that score `least`
    (1 or more) or above; equal scores by place."""
    none = np.zeros(0, np.int64)
    if int(s.bounds[terms].sum()) < least:
        return none, none
    size = s.borders[terms + 1] - s.borders[terms]
    few, many = terms[size <= short], terms[size > short]
    iterators = [
        (int(s.bounds[t]), s.places[s.borders[t] : s.borders[t + 1]], s.scores[s.borders[t] : s.borders[t + 1]])
        for t in many.tolist()
    ]
    if len(few):
        members, _ = spread(s.borders[few], s.borders[few + 1])
        sums = np.zeros(s.n_docs, np.int64)
        np.add.at(sums, s.places[members], s.scores[members])
        some = np.flatnonzero(sums)
        if len(some):
            iterators.append((int(sums[some].max()), some, sums[some]))
    iterators.sort(key=lambda x: x[0])
    reach = np.cumsum([b for b, _, _ in iterators])
    best, score = none, none
    for start in range(0, s.n_docs, step):
        passive = int(np.searchsorted(reach, least))  # together these stay below `least`
        if passive == len(iterators):
            break
        sums = np.zeros(step, np.int64)
        for _, places, scores in iterators[passive:]:
            a, b = np.searchsorted(places, (start, start + step))
            sums[places[a:b] - start] += scores[a:b]
        found = np.flatnonzero(sums)
        value = sums[found]
        found = found + start
        for j in range(passive - 1, -1, -1):
            able = value + reach[j] >= least
            found, value = found[able], value[able]
            if not len(found):
                break
            _, places, scores = iterators[j]
            at = np.minimum(np.searchsorted(places, found), len(places) - 1)
            value = value + np.where(places[at] == found, scores[at], 0)
        able = value >= least
        if able.any():
            best, score = np.concatenate((best, found[able])), np.concatenate((score, value[able]))
            order = np.lexsort((best, -score))[:k]
            best, score = best[order], score[order]
            if len(best) == k:
                least = max(least, int(score[-1]))
    return best, score


def search(
    index: DataFrame,
    queries: DataFrame,
    item_id: str = "item_id",
    text: str = "text",
    doc_id: str = "doc_id",
    k: int = TOP,
    block_bytes: int = BLOCK_BYTES,
    short_share: int = SHORT_SHARE,
) -> DataFrame:
    """The k best documents of `index` for each row of `queries`: item_id, rank (from 1), the
    document's id and its score, above 0."""
    spark = index.sparkSession
    items = queries.select(quoted(item_id).alias("id"), quoted(text).alias("text")).where(F.col("text").isNotNull())
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // block_bytes))
    id_type = index.schema["ids"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("q", T.LongType()),
            T.StructField(item_id, items.schema["id"].dataType),
            T.StructField(doc_id, id_type),
            T.StructField("score", T.LongType()),
        ]
    )

    def scorer(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q: Queries = shared.value
            tops: list[list[tuple]] = [[] for _ in q.codes]
            ids_kind = item_kind = None
            for batch in batches:
                ids_kind = batch.schema.field("ids").type.value_type
                for r in range(batch.num_rows):
                    row = {name: batch.column(name)[r].as_py() for name in batch.schema.names if name != "ids"}
                    lists = _lists(row, q)
                    if lists is None:
                        continue
                    ids = batch.column("ids")[r].values
                    for j, codes in enumerate(q.codes):
                        terms = lists.list_of[codes]
                        terms = terms[terms >= 0]
                        if not len(terms):
                            continue
                        top = tops[j]
                        least = -top[-1][0] if len(top) == k else 1
                        places, scores = best_of_shard(lists, terms, least, k, lists.n_docs // short_share)
                        if len(places):
                            new = zip(ids.take(pa.array(places)).to_pylist(), scores.tolist(), strict=True)
                            top += [(-score, i is None, i) for i, score in new]
                            top.sort(key=lambda x: x[:2] if x[1] else x)
                            del top[k:]
            found = [(j, q.names[j], i, -score) for j, top in enumerate(tops) for score, _, i in top]
            if found:
                number, name, doc, score = zip(*found, strict=True)
                item_kind = pa.from_numpy_dtype(np.int64)
                columns = [pa.array(number, item_kind), pa.array(name), pa.array(doc, ids_kind), pa.array(score, item_kind)]
                yield pa.RecordBatch.from_arrays(columns, names=["q", item_id, doc_id, "score"])

        return run

    parts = []
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.expr(f"pmod(xxhash64(text), {blocks})") == b)
        block = _queries([(r["id"], r["text"]) for r in part.collect()])  # bounded by block_bytes
        _weigh(index, block)
        shared = spark.sparkContext.broadcast(block)
        found = index.mapInArrow(scorer(shared), schema)
        best = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last(quoted(doc_id)))
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        parts.append(ranked.select(quoted(item_id), "rank", quoted(doc_id), "score"))
    return reduce(DataFrame.unionByName, parts)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    index = build_index(table(spark, sf_dir, "documents"))
    return search(index, table(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
b AS MATERIALIZED (
  SELECT DISTINCT q, item_id, unnest(w) AS term
  FROM (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS w FROM benchmark)),
totals AS (SELECT count(*) FILTER (len(w) > 0)::BIGINT AS N, sum(len(w))::BIGINT AS L FROM d),
tf AS MATERIALIZED (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM b) GROUP BY r, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, totals GROUP BY term, N),
scores AS (
  SELECT q, item_id, r, d.doc_id,
    sum(x.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(d.w) * N) // L))))::BIGINT AS score
  FROM b JOIN tf USING (term) JOIN weights x USING (term) JOIN d USING (r), totals
  GROUP BY q, item_id, r, d.doc_id)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
