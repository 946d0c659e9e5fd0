"""Language identification by cross-parsing entropy.

A text is parsed into the longest phrases that occur in a language's sample. The more
alike the text and the sample, the longer and fewer the phrases; with N symbols of sample
and n symbols of text, phrases * log2(N + 1) / n estimates the bits per symbol that the
text costs given the language. The cheapest language wins.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterflow.llm.common import crc_remainder, empty_if_null, fresh
from meterflow.llm.suffix_automaton import parse_table, phrases

#: What a language is learned from: so many distinct texts, and of each so many pieces of so many characters.
SAMPLE_DOCS, PIECES, PIECE_CHARS = 40, 4, 250
#: Letters with a symbol of their own; others share a few by code block.
LETTERS, SHARED = 90, 8
SPACE, FIRST = 1, 2
HOLDOUT = 5
UNKNOWN = "und"
#: A score counts the evidence of so many symbols at most, else every longer text would score 1. It changes no verdict.
SURE_AFTER = 50
#: By default, texts of at least `LEAST` characters that cost more bits per symbol resemble no learned language.
LEAST, MOST_BITS = 100, 5.0


@dataclass
class LanguageModel:
    languages: list[str]
    symbol_of: np.ndarray  # by code point
    table: np.ndarray
    roots: np.ndarray
    sizes: np.ndarray

    def symbols(self, text: str) -> np.ndarray:
        """Letters in lower case as symbols, all else as single spaces."""
        symbols = self.symbol_of[np.frombuffer(text.encode("utf-32-le"), "<u4")]
        again = np.zeros(len(symbols), bool)
        again[1:] = (symbols[1:] == SPACE) & (symbols[:-1] == SPACE)
        return symbols[~again]

    def costs(self, texts: list[np.ndarray]) -> np.ndarray:
        """Bits per symbol of each text (rows) in each language (columns)."""
        lengths = np.maximum([len(text) for text in texts], 1)
        return phrases(self.table, self.roots, texts) * np.log2(self.sizes + 1.0) / lengths[:, None]

    def predict(self, texts: list[str]) -> list[tuple[str, float, float | None]]:
        """Language, score and bits per symbol of each text; ties go to the first language in order."""
        parsed = [self.symbols(text) for text in texts]
        lettered = [bool((symbols != SPACE).any()) for symbols in parsed]
        if not self.languages:
            return [(UNKNOWN, 0.0, None)] * len(texts)
        costs = self.costs(parsed)
        best = costs.argmin(axis=1)
        lengths = np.minimum([len(symbols) for symbols in parsed], SURE_AFTER)
        shares = np.exp2(-(costs - costs.min(axis=1, keepdims=True)) * lengths[:, None])
        scores = 1.0 / shares.sum(axis=1)
        return [
            (self.languages[b], float(score), float(cost[b])) if known else (UNKNOWN, 0.0, None)
            for known, b, score, cost in zip(lettered, best, scores, costs)
        ]


def _symbol_table(letters: list[str]) -> np.ndarray:
    """Symbol of every code point: its lower-case letter's own, or a shared one, or that of a space."""
    own = {letter: FIRST + i for i, letter in enumerate(letters)}
    table = np.full(0x110000, SPACE, np.uint8)
    for code in range(0x110000):
        letter = chr(code)
        if letter.isalpha():
            letter = letter.lower()[0]
            table[code] = own.get(letter) or FIRST + len(letters) + (ord(letter) >> 7) % SHARED
    return table


def model_from(samples: dict[str, list[str]]) -> LanguageModel:
    """Learn from labelled texts. No texts give a model that knows no language."""
    counts = Counter(letter for texts in samples.values() for text in texts for letter in text.lower() if letter.isalpha())
    letters = sorted(counts, key=lambda letter: (-counts[letter], letter))[:LETTERS]
    model = LanguageModel([], _symbol_table(letters), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0))
    tables, roots, sizes, base = [], [], [], 0
    for language in sorted(samples):
        symbols = model.symbols(" ".join(samples[language]))
        if not (symbols != SPACE).any():
            continue
        tables.append(parse_table(symbols.tolist(), FIRST + len(letters) + SHARED, base))
        model.languages.append(language)
        roots.append(base)
        sizes.append(len(symbols))
        base += len(tables[-1])
    if tables:
        model.table, model.roots, model.sizes = np.concatenate(tables), np.array(roots, np.int32), np.array(sizes)
    return model


def sample_pieces(text: Column, h: Column) -> Column:
    """Pieces of a text, joined: one from a hashed place in each of as many equal parts. Short texts are taken whole."""
    width = F.length(text) / PIECES
    spare = F.greatest(width - PIECE_CHARS, F.lit(0.0))
    pieces = []
    for n in range(PIECES):
        shift = spare * F.pmod(F.xxhash64(h, F.lit(n)), F.lit(1_000)) / 1_000.0
        pieces.append(F.substring(text, (F.floor(width * n + shift) + 1).cast("int"), F.lit(PIECE_CHARS)))
    return F.when(F.length(text) <= PIECES * PIECE_CHARS, text).otherwise(F.concat_ws(" ", *pieces))


def learn(docs: DataFrame) -> LanguageModel:
    """Learn from the documents that aren't held out: per language the distinct texts with the smallest hashes.

    The sample is bounded by `SAMPLE_DOCS`, `PIECES` and `PIECE_CHARS` per language. Rows with
    a null id or language, or without a letter, teach nothing; copies of a text count once.
    """
    known = docs.filter(
        (crc_remainder(F.col("doc_id"), HOLDOUT) != 0) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    ).select("lang", F.xxhash64("text").alias("h"), "text")
    first = Window.partitionBy("lang").orderBy("h")
    lowest = known.select("lang", "h").distinct().withColumn("nth", F.row_number().over(first))
    bounds = lowest.filter(F.col("nth") <= SAMPLE_DOCS).groupBy("lang").agg(F.max("h").alias("bound")).collect()
    if not bounds:
        return model_from({})
    limits = F.create_map(*[F.lit(part) for row in bounds for part in (row.lang, row.bound)])
    chosen = known.filter(F.col("h") <= F.element_at(limits, F.col("lang")))
    texts = chosen.groupBy("lang", "h").agg(F.min(sample_pieces(F.col("text"), F.col("h"))).alias("text"))
    samples: dict[str, list[str]] = {row.lang: [] for row in bounds}
    for row in sorted(texts.collect(), key=lambda row: (row.lang, row.h)):
        samples[row.lang].append(row.text)
    return model_from(samples)


def prediction(spark: SparkSession, model: LanguageModel) -> Callable[[Column], Column]:
    """A function of the text: struct of `lang_pred`, `score`, `bits` (per symbol; null if undetermined)."""
    shared = spark.sparkContext.broadcast(model)
    fields = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("bits", pa.float64()), ("n", pa.int64())])

    @F.arrow_udf("struct<lang_pred: string, score: double, bits: double, n: bigint>")
    def predict(texts: pa.Array) -> pa.Array:
        texts = empty_if_null(texts)
        return pa.array([(*found, len(text)) for found, text in zip(shared.value.predict(texts), texts)], fields)

    return predict


def predicted_languages(docs: DataFrame) -> DataFrame:
    """`doc_id`, `held_out`, `lang_pred`, `score` and `bits` of every row.

    A null text or one without a letter is `und` with score 0; if nothing is labelled, all
    are. A null id counts as not held out but isn't learned from. Repeated rows each get
    their row, an empty table gives none, other columns are ignored.
    """
    found = prediction(docs.sparkSession, learn(docs))(F.col("text"))
    held_out = F.coalesce(crc_remainder(F.col("doc_id"), HOLDOUT) == 0, F.lit(False))
    return docs.select("doc_id", held_out.alias("held_out"), found.alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score", "p.bits"
    )


def in_known_language(docs: DataFrame, least: int = LEAST, most_bits: float = MOST_BITS) -> DataFrame:
    """The documents in a learned language: not those undetermined, nor longer ones that resemble no language.

    Null texts and those without a letter go. Each row is judged by itself, so rows that
    repeat an id or a text share its fate, and null ids don't matter; ties between languages
    reject nothing. Without any labelled text all go. An empty table gives no rows.
    """
    (verdict,) = fresh(docs, "_language")
    found = docs.withColumn(verdict, prediction(docs.sparkSession, learn(docs))(F.col("text")))
    alien = (F.col(verdict)["n"] >= least) & (F.col(verdict)["bits"] > most_bits)
    return found.filter((F.col(verdict)["lang_pred"] != UNKNOWN) & ~alien).drop(verdict)
