"""Language identification by cross-parsing.

For each language a suffix automaton of some labelled text is built. A document is parsed
against each of them from left to right: a phrase is the longest piece of the rest that occurs
in that language's text (a symbol that does not occur there is a phrase of its own). The phrases
per symbol, times the logarithm of the length of the automaton's text, estimate the cross
entropy, and the language with the least wins.

Text is read as symbols: letters by lower case (the most frequent of the training text have
symbols of their own, all others share some by code block), runs of anything else as one blank.
Long texts are parsed whole, in stretches of `STRETCH` symbols, each begun with a new phrase.

Training takes a bounded sample of labelled rows: `SAMPLE_DOCS` documents of a language, drawn
by hash, and of each `SAMPLE_CHARS` characters from a place drawn by hash, for the
`MAX_LANGUAGES` languages with the most rows; automata of all languages have `TABLE_BYTES` at
most, by taking less text of each. Scoring covers every document and every character.

Defined results: a null text, an empty one or one without a letter is `und` with score 0; rows
with a null label or text teach nothing; with no labelled row every text is `und`; of languages
that fit equally well the first by name wins, with score 0; with one language learned the score
is 1; an empty table gives an empty result; extra columns are kept whatever they are called.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestdoc.llm._frames import quoted, table, unit_hash
from nestdoc.llm._words import chunks, utf8

UNDETERMINED = "und"
SAMPLE_DOCS = 80
SAMPLE_CHARS = 300
MAX_LANGUAGES = 200
TABLE_BYTES = 48 << 20
STRETCH = 1024
CHUNK_BYTES = 2 << 20

_BLANK, _SHARED, _OWN = 0, 1, 33  # symbols: blank, 32 that rarer letters share, then one a letter
_MOST_SYMBOLS = 160


@dataclass
class LanguageModel:
    languages: list[str]
    symbol_of: np.ndarray  # by code point
    n_symbols: int
    steps: list[np.ndarray]  # by state * n_symbols + symbol: (next state * n_symbols) * 4 + phrases closed
    logs: list[float]


def symbols_for(texts: list[str]) -> tuple[np.ndarray, int]:
    """Symbol of every code point, and how many symbols there are."""
    lower = np.zeros(0x110000, np.int64)
    for c in range(0x110000):
        if unicodedata.category(ch := chr(c))[0] == "L":
            low = ch.lower()
            lower[c] = ord(low) if len(low) == 1 else c
    seen = Counter()
    for text in texts:
        seen.update(lower[_code_points(text)].tolist())
    seen.pop(0, None)
    own = sorted(c for c, _ in seen.most_common(_MOST_SYMBOLS - _OWN))
    place = np.where(lower > 0, _SHARED + (lower >> 7) % (_OWN - _SHARED), _BLANK)
    for k, c in enumerate(own):
        place[lower == c] = _OWN + k
    return place.astype(np.uint8), _OWN + len(own)


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def read_symbols(points: np.ndarray, row: np.ndarray, symbol_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and their rows; of several blanks in a row of text one stays."""
    s = symbol_of[points]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != _BLANK) | (s[:-1] != _BLANK) | (row[1:] != row[:-1])
    return s[keep], row[keep]


def suffix_automaton(s: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that reads exactly the substrings of s; 0 is its start."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in s:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step


def parse_table(step: list[dict[int, int]], n_symbols: int) -> np.ndarray:
    """The automaton as one array that also starts the next phrase where none continues."""
    table_ = np.zeros((len(step), n_symbols), np.int32)
    begin = np.full(n_symbols, 1, np.int32)  # no such symbol: it is a phrase, then from the start
    for c, to in step[0].items():
        begin[c] = (to * n_symbols) << 2
    table_[:] = begin
    table_[1:] += 1  # the phrase read so far is closed
    for state, on in enumerate(step):
        for c, to in on.items():
            table_[state, c] = (to * n_symbols) << 2
    return table_.reshape(-1)


def fit(rows: list[tuple[str, str]]) -> LanguageModel:
    """Model of (language, text) rows, without rows that the other half of them would call another
    language: wrong labels and foreign passages would give a language long phrases of another."""
    rows = _sentences(rows)
    halves = [rows[0::2], rows[1::2]]
    kept = []
    for mine, other in (halves, halves[::-1]):
        langs, _ = predict(fit_all(other), pa.array([t for _, t in mine], pa.string()))
        kept += [r for r, lang in zip(mine, langs, strict=True) if lang == r[0]]
    known = {lang for lang, _ in kept}
    return fit_all([*kept, *(r for r in rows if r[0] not in known)])


def _sentences(rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The rows with each of a language's sentences once, without those that several have: lines
    and passages that documents of all languages share say nothing of any."""
    seen: dict[str, set[str]] = defaultdict(set)
    cut = [(lang, [s.strip() for s in re.split(r"(?<=[.!?])\s|\n", text)]) for lang, text in sorted(rows)]
    for lang, sentences in cut:
        for s in sentences:
            seen[s].add(lang)
    out = []
    for lang, sentences in cut:
        mine = [s for s in dict.fromkeys(sentences) if s and len(seen[s]) == 1]
        for s in mine:
            seen[s].add("")  # the next time it isn't new
        if mine:
            out.append((lang, " ".join(mine)))
    return out if {lang for lang, _ in out} == {lang for lang, _ in rows} else sorted(rows)


def fit_all(rows: list[tuple[str, str]]) -> LanguageModel:
    """Model of all the rows."""
    texts: dict[str, list[str]] = defaultdict(list)
    for lang, text in sorted(rows):
        texts[lang].append(text)
    symbol_of, n = symbols_for([t for ts in texts.values() for t in ts])
    most = TABLE_BYTES // (max(1, len(texts)) * n * 8)  # a text of m symbols has 2 m states at most
    model = LanguageModel([], symbol_of, n, [], [])
    for lang in sorted(texts):
        points = _code_points(" ".join(texts[lang]))
        s, _ = read_symbols(points, np.zeros(len(points), np.int8), symbol_of)
        if (s != _BLANK).any():
            s = s[:most]
            model.languages.append(lang)
            model.steps.append(parse_table(suffix_automaton(s.tolist()), n))
            model.logs.append(math.log2(len(s) + 1))
    return model


def phrases(model: LanguageModel, s: np.ndarray, row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of each row against each language, and the symbols of each row."""
    size = np.bincount(row, minlength=n_rows)
    first = np.cumsum(size) - size
    stretches = -(-size // STRETCH)
    of = np.repeat(np.arange(n_rows), stretches)
    part = np.arange(len(of)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
    begin = first[of] + part * STRETCH
    left = np.minimum(size[of] - part * STRETCH, STRETCH)
    order = np.argsort(-left, kind="stable")
    of, begin, left = of[order], begin[order], left[order]
    longest = int(left[0]) if len(left) else 0
    lanes = np.searchsorted(-left, -np.arange(longest), "left")  # stretches longer than t
    out = np.zeros((len(model.steps), n_rows), np.int64)
    cur = np.zeros((len(model.steps), len(of)), np.int32)
    count = np.zeros((len(model.steps), len(of)), np.int32)
    for t in range(longest):
        n = lanes[t]
        c = s[begin[:n] + t]
        for k, steps in enumerate(model.steps):
            v = steps[cur[k, :n] + c]
            count[k, :n] += v & 3
            cur[k, :n] = v >> 2
    count += cur != 0  # the last phrase
    for k in range(len(model.steps)):
        out[k] = np.bincount(of, weights=count[k], minlength=n_rows)
    return out, size


def predict(model: LanguageModel, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    n = len(column)
    data, offsets = utf8(column)
    points = _code_points(data.tobytes().decode("utf-8", "replace"))
    leads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)))
    row = np.repeat(np.arange(n, dtype=np.int32), np.diff(leads[offsets]))
    del leads
    s, row = read_symbols(points, row, model.symbol_of)
    del points
    lettered = np.bincount(row[s != _BLANK], minlength=n) > 0
    if not model.languages:
        return [UNDETERMINED] * n, np.zeros(n)
    count, size = phrases(model, s, row, n)
    cost = count * np.array(model.logs)[:, None] / np.maximum(size, 1)
    best = np.argmin(cost, axis=0)
    ranked = np.sort(cost, axis=0)
    score = 1 - ranked[0] / np.maximum(ranked[1], 1e-12) if len(ranked) > 1 else np.ones(n)
    langs = np.array([*model.languages, UNDETERMINED], object)[np.where(lettered, best, len(model.languages))]
    return langs.tolist(), np.where(lettered, score, 0.0)


def labelled_sample(docs: DataFrame, use: Column, text: str, lang: str) -> list[tuple[str, str]]:
    """Bounded sample of (language, piece of text), alike on every run."""
    t, label = quoted(text), quoted(lang).cast("string")
    rows = docs.where(use & label.isNotNull() & t.isNotNull()).select(label.alias("lang"), t.alias("text"))
    rows = rows.withColumn("u", unit_hash(F.col("text")))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES)
    # About eight times as many as needed, so that the window sorts a bounded number of rows.
    likely = rows.join(F.broadcast(counts.withColumnRenamed("lang", "l")), F.col("lang") == F.col("l"))
    likely = likely.where(F.col("u") * F.col("n") < 8 * SAMPLE_DOCS)
    at = F.floor(unit_hash(F.col("text"), F.lit("place")) * F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0))) + 1
    piece = F.substring(F.col("text"), at.cast("int"), F.lit(SAMPLE_CHARS))
    order = Window.partitionBy("lang").orderBy("u", "piece")
    best = (
        likely.where(F.length("text") > 0).select("lang", "u", piece.alias("piece"))
        .withColumn("k", F.row_number().over(order)).where(F.col("k") <= SAMPLE_DOCS)
    )
    return [(r["lang"], r["piece"]) for r in best.select("lang", "piece").collect()]


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """`docs` plus the predicted language and its score (0 to 1: how much fewer phrases than the
    second language), in columns of the names given."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text, CHUNK_BYTES):
            langs, scores = predict(shared.value, part.column(part.schema.get_field_index(text)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*part.schema.names, lang, score]
            )

    schema = T.StructType([*docs.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def train(docs: DataFrame, use: Column | None = None, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Model of the labelled rows of `docs` for which `use` holds."""
    return fit(labelled_sample(docs, F.lit(True) if use is None else use, text, lang))


def held_out(doc_id: Column) -> Column:
    """Rows that teach nothing: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs, ~held_out(F.col("doc_id")))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
