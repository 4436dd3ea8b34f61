"""Language identification by language-bitmask n-gram filters.

Learning counts the letter trigrams of every language over all learnt rows: a
task adds its texts up in one array per language and emits what it met, Spark
sums.  Every trigram that a language has goes into its Bloom filter.  The filters
are bit-sliced: one cell holds one bit for every language, in 64-bit slices, so
one look-up of PROBES cells, joined by AND, returns all languages that contain a
trigram.  Per-language popcounts over a text's trigrams, less the false positives
that a filter of its fill gives, decide.  The cells follow the number of trigrams
of the richest language, CELLS_PER_GRAM each, and there are 2 ** GRAM_BITS
trigrams at most; only the cells, and the names of the languages, pass through
the driver.

A language's score is the corrected share of the text's trigrams that it holds.

Rejection (recognised) takes its levels from the learnt rows: they are dealt into
two folds, and each fold's rows are scored by filters of the other.  That gives,
for each language and each band of text lengths (powers of two of the number of
trigrams), how its own texts score; a text is rejected if it scores less than
TAIL of them, by SLACK.  Bands of few rows take the level of the next shorter
band if that is lower.

Edge cases: a text that is null or has no letters (str.isalpha) is `und` with
score 0, and so is every text if there is nothing to learn from; ties go to the
language first in code point order, a text of unknown trigrams too; rows without
doc_id are not learnt from, and predicted like any other; an empty table gives an
empty result; repeated rows get equal predictions; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.llm.base import crc_share, stage
from rowmill.llm.learning import held_out

PARTS, REMAINDER = 5, 0
UNKNOWN = "und"
TAIL, SLACK = 0.001, 0.05
FOLDS = 2
LEAST_ROWS = 200
STEPS = 1000
CELLS_PER_GRAM, PROBES = 16, 3
GRAM_BITS = 18
HELD_GRAMS = 1 << 20
LETTERS = re.compile(r"[^\W\d_]+")
# odd numbers of one multiplicative hash per probe
FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def _byte_codes() -> np.ndarray:
    """Six bits a byte: space 0, letters a to z 1 to 26, other bytes the rest."""
    codes = 27 + np.arange(256) % 37
    codes[ord(" ")] = 0
    codes[ord("a") : ord("z") + 1] = np.arange(1, 27)
    return codes.astype(np.int64)


_CODES = _byte_codes()


def grams(text: str | None) -> np.ndarray:
    """The trigram numbers of a text's letters; none if it has no letters."""
    words = LETTERS.findall((text or "").lower())
    if not "".join(words).isalpha():  # none, or numerals among them that are no letters
        words = "".join(c if c.isalpha() else " " for c in " ".join(words)).split()
    if not words:
        return np.empty(0, np.int64)
    line = f" {' '.join(words)} ".encode("utf-8", "surrogatepass")
    c = _CODES[np.frombuffer(line, np.uint8)]
    return (c[:-2] << 12) | (c[1:-1] << 6) | c[2:]


def _places(gram: np.ndarray, k: int, bits: int) -> np.ndarray:
    """The cells of trigrams for one probe: the upper `bits` of 32 hashed bits."""
    return ((gram * FACTORS[k]) & 0xFFFFFFFF) >> (32 - bits)


def _place_column(k: int, bits: int):
    return F.shiftright((F.col("gram") * F.lit(FACTORS[k])).bitwiseAND(F.lit(0xFFFFFFFF)), 32 - bits)


def _fold():
    """The fold of a learnt row, by other bits than those that hold rows out."""
    return F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(FOLDS)).cast("int")


def _learnt(docs: DataFrame) -> DataFrame:
    """lang, fold and text of the rows to learn from."""
    known = F.col("lang").isNotNull() & (crc_share(F.col("doc_id"), PARTS) != REMAINDER)
    return docs.where(known).select(F.col("lang").cast("string").alias("lang"), _fold().alias("fold"), "text")


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, fold, gram, n over the rows to learn from."""

    def run(batches):
        sums: dict[tuple, np.ndarray] = {}
        for b in batches:
            by: dict[tuple, list[np.ndarray]] = {}
            held = 0
            for lang, fold, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                by.setdefault((lang, fold), []).append(grams(text.as_py()))
                held += len(by[lang, fold][-1])
                if held > HELD_GRAMS:
                    add(sums, by)
                    by, held = {}, 0
            add(sums, by)
            if len(sums) > 64:  # many languages: hand on and start again
                yield from out(sums)
                sums = {}
        yield from out(sums)

    def add(sums, by):
        for key, found in by.items():
            n = np.bincount(np.concatenate(found), minlength=1 << GRAM_BITS)
            sums[key] = sums[key] + n if key in sums else n

    def out(sums):
        for (lang, fold), n in sums.items():
            met = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(met), pa.string()), pa.array(np.full(len(met), fold, np.int32)),
                 pa.array(met), pa.array(n[met])], ["lang", "fold", "gram", "n"],
            )

    partial = _learnt(docs).mapInArrow(run, "lang string, fold int, gram long, n long")
    return partial.groupBy("lang", "fold", "gram").agg(F.sum("n").alias("n"))


class Filters:
    """The bit-sliced cells, the languages' names and their false positive rates."""

    def __init__(self, names: list[str], cells: np.ndarray):
        self.names, self.cells = names, cells
        self.bits = len(cells).bit_length() - 1
        fill = np.array([np.mean((cells[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)) for i in range(len(names))])
        self.false = fill**PROBES

    def shares(self, found: np.ndarray) -> np.ndarray:
        """The corrected share of the trigrams that each language contains."""
        distinct, n = np.unique(found, return_counts=True)
        masks = self.cells[_places(distinct, 0, self.bits)]
        for k in range(1, PROBES):
            masks = masks & self.cells[_places(distinct, k, self.bits)]
        total, out = n.sum(), np.empty(len(self.names))
        for i in range(len(self.names)):
            held = n[(masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1) == 1].sum() / total
            out[i] = (held - self.false[i]) / max(1e-9, 1 - self.false[i])
        return np.clip(out, 0, 1)

    def predict(self, text: str | None) -> tuple[str, float, int]:
        """Language, score and number of trigrams."""
        found = grams(text)
        if not len(found) or not self.names:
            return UNKNOWN, 0.0, 0
        shares = self.shares(found)
        best = int(np.argmax(shares))
        return self.names[best], float(shares[best]), len(found)


def _filters(counts: DataFrame, names: list[str]) -> Filters:
    """The filters of all trigrams in counts (lang, gram)."""
    kept = counts.select("lang", "gram").distinct()
    richest = kept.groupBy("lang").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    bits = max(6, (CELLS_PER_GRAM * richest - 1).bit_length())
    numbers = counts.sparkSession.createDataFrame(list(enumerate(names)), "number int, lang string")
    bit = F.expr("shiftleft(1L, number % 64)")
    cell = F.explode(F.array(*[_place_column(k, bits) for k in range(PROBES)]))
    masks = kept.join(F.broadcast(numbers), "lang").select(
        cell.alias("cell"), F.expr("number div 64").alias("slice"), bit.alias("bit")
    ).groupBy("cell", "slice").agg(F.bit_or("bit").alias("mask")).toArrow()
    cells = np.zeros((1 << bits, max(1, -(-len(names) // 64))), np.uint64)
    if len(masks):
        cells[masks["cell"].to_numpy(), masks["slice"].to_numpy()] = masks["mask"].to_numpy().view(np.uint64)
    return Filters(names, cells)


def _counts(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    counts = stage(gram_counts(docs), "gram-counts")
    return counts, [r[0] for r in counts.select("lang").distinct().orderBy("lang").collect()]


def learn(docs: DataFrame) -> Filters:
    return _filters(*_counts(docs))


def band(n_grams: int) -> int:
    """The band of a text's length."""
    return n_grams.bit_length()


def own_scores(docs: DataFrame, by_fold: list[Filters]) -> DataFrame:
    """lang, band, step and n: how many learnt rows score in each of STEPS steps for
    their own language, by the filters of the other fold."""
    model = docs.sparkSession.sparkContext.broadcast(by_fold)

    def run(batches):
        number = {name: i for i, name in enumerate(model.value[0].names)}
        for b in batches:
            sums: dict[tuple, int] = {}
            for lang, fold, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                found = grams(text.as_py())
                if len(found):
                    score = model.value[1 - fold].shares(found)[number[lang]]
                    key = (lang, band(len(found)), int(score * STEPS))
                    sums[key] = sums.get(key, 0) + 1
            rows = [(*key, n) for key, n in sums.items()]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)

    schema = pa.schema([("lang", pa.string()), ("band", pa.int32()), ("step", pa.int32()), ("n", pa.int64())])
    partial = _learnt(docs).mapInArrow(run, "lang string, band int, step int, n long")
    return partial.groupBy("lang", "band", "step").agg(F.sum("n").alias("n"))


def levels(scores) -> dict[tuple[str, int], float]:
    """(language, band) -> the score under which a text is rejected.  scores: rows
    (lang, band, step, n), at most STEPS + 1 for each band of a language."""
    held: dict[str, dict[int, dict[int, int]]] = {}
    for lang, at, step, n in scores:
        held.setdefault(lang, {}).setdefault(at, {})[step] = n
    out = {}
    for lang, bands in held.items():
        shorter = 0.0
        for at in range(max(64, *bands) + 1):
            counts = bands.get(at, {})
            total, level = sum(counts.values()), None
            left = TAIL * total
            for step in sorted(counts):
                left -= counts[step]
                if left < 0:
                    level = step / STEPS - SLACK
                    break
            if level is None or (total < LEAST_ROWS and level > shorter):
                level = shorter
            out[lang, at] = shorter = max(0.0, level)
    return out


def learn_levels(docs: DataFrame) -> tuple[Filters, dict[tuple[str, int], float]]:
    """Filters of all learnt rows and the levels of rejection."""
    counts, names = _counts(docs)
    by_fold = [_filters(counts.where(F.col("fold") == k), names) for k in range(FOLDS)]
    return _filters(counts, names), levels(map(tuple, own_scores(docs, by_fold).collect()))


def identify(docs: DataFrame, filters: Filters | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    model = docs.sparkSession.sparkContext.broadcast(filters or learn(docs))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            found = [model.value.predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0), pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    rows = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")
    return rows.select("doc_id", held_out(PARTS, REMAINDER).alias("held_out"), "lang_pred", "score")


def recognised(docs: DataFrame) -> DataFrame:
    """The documents in a learnt language; rejected are texts without letters and
    those that score less than the learnt language's own texts of that length do."""
    model = docs.sparkSession.sparkContext.broadcast(learn_levels(docs))
    at = docs.columns.index("text")

    def run(batches):
        filters, least = model.value
        for b in batches:
            found = [filters.predict(t.as_py()) for t in b.column(at)]
            keep = [lang != UNKNOWN and score >= least.get((lang, band(n)), 0.0) for lang, score, n in found]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
