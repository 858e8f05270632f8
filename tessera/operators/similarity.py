"""Similarity to a target set and global top-K."""

import hashlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import plain
from ..plans.config import Similarity

#: Targets go to the executors in parts of at most so many bytes of vectors; each part is one pass.
PART_BYTES = 256 << 20
#: A Python worker holds the vectors of at most so many rows at a time, and so many bytes of their scores (of one row at least), however many rows Spark sends in a batch.
SLICE_ROWS, SLICE_BYTES = 512, 16 << 20
#: Hashes of words are kept, of so many words at most and of none with more characters.
_KNOWN_WORDS, _LONG_WORD = 1 << 16, 64
_known: dict[str, int] = {}


def unit(v: Column) -> Column:
    """The vector over its L2 norm, in double; a zero vector stays."""
    d = F.transform(v, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(norm > 0, F.transform(d, lambda x: x / norm)).otherwise(d)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def _hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")


def hash_vectors(texts: Iterable[str | None], dim: int, n: int | None = None) -> np.ndarray:
    """Signed feature hashing of the words by BLAKE2b; a text without words is one feature of itself. ``n``: how many texts there are, if they have no length."""
    out = np.zeros((len(texts) if n is None else n, dim))
    for row, text in enumerate(texts):
        words = (text or "").split()
        if not words:
            out[row, _hash(text or "") % dim] = 1.0
            continue
        for word, k in Counter(words).items():
            if (h := _known.get(word)) is None:
                h = _hash(word)
                if len(word) <= _LONG_WORD:
                    if len(_known) >= _KNOWN_WORDS:
                        _known.clear()
                    _known[word] = h
            out[row, h % dim] += k if h >> 8 & 1 else -k
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    out /= np.where(norm > 0, norm, 1)
    return out


def slices(batches: Iterator[pa.Array], rows: int = SLICE_ROWS) -> Iterator[pa.Array]:
    """The batches in slices, without copies."""
    for b in batches:
        for at in range(0, len(b), rows):
            yield b.slice(at, rows)


def _text_vectors(texts: pa.Array, dim: int) -> np.ndarray:
    """One text at a time is a Python string."""
    return hash_vectors((t.as_py() for t in texts), dim, len(texts))


def hash_embed(df: DataFrame, text: str, dim: int = Similarity.dim, name: str = "embedding") -> DataFrame:
    """All columns and the hash embedding of a text column; a null text counts as empty. Where only the best target is wanted, ``best_hashed`` spares the vectors' way through the JVM."""

    @F.arrow_udf("array<double>")
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in slices(batches):
            yield pa.ListArray.from_arrays(np.arange(0, len(texts) * dim + 1, dim, dtype=np.int32), pa.array(_text_vectors(texts, dim).ravel()))

    return df.withColumn(name, embed(F.col(text).cast("string")))


def candidate_text(instruction: Column, input_: Column, output: Column, cfg: Similarity = Similarity()) -> Column:
    """The template over the stripped fields, stripped."""
    template = cfg.template.replace("\n", "\\n") if cfg.literal_escapes else cfg.template
    fields = {"instruction": instruction, "input": input_, "output": output}
    parts: list[Column] = []
    rest = template
    while rest:
        at = min((rest.find("{" + k + "}"), k) for k in fields if "{" + k + "}" in rest) if any("{" + k + "}" in rest for k in fields) else None
        if at is None:
            parts.append(F.lit(rest))
            break
        if at[0]:
            parts.append(F.lit(rest[: at[0]]))
        parts.append(plain(fields[at[1]]))
        rest = rest[at[0] + len(at[1]) + 2 :]
    return plain(F.concat(*parts)) if parts else F.lit("")


def with_candidates(df: DataFrame, text: Column, name: str = "candidate_text") -> DataFrame:
    """The rows with their candidate text; those whose text is empty are skipped (``candidate_report`` counts them)."""
    return df.withColumn(name, plain(text)).where(F.col(name) != "")


def candidate_report(df: DataFrame, text: Column) -> DataFrame:
    """One row: total_read, skipped_empty_text, encoded."""
    empty = plain(text) == ""
    return df.agg(F.count(F.lit(1)).alias("total_read"), F.count_if(empty).alias("skipped_empty_text"), F.count_if(~empty).alias("encoded"))


def with_reference(df: DataFrame, known: DataFrame, prompt: str = "prompt", columns: tuple[str, ...] = ("reference_answer", "answer_keywords", "risk_level")) -> DataFrame:
    """All rows, with the columns that ``known`` has for their prompt (nulls where it has none); of several entries of a prompt the last in column order counts."""
    one = known.groupBy(F.col(prompt).alias("__prompt")).agg(F.max(F.struct(*columns)).alias("__known"))
    return df.join(one, df[prompt] == one["__prompt"], "left").select(*(df[c] for c in df.columns), *(F.col(f"__known.{c}").alias(c) for c in columns))


def checked_targets(targets: DataFrame, text: str = "target_text") -> DataFrame:
    """The targets, if there are any and none is blank; else an error."""
    blank, n = targets.agg(F.count_if(F.coalesce(plain(F.col(text)), F.lit("")) == ""), F.count(F.lit(1))).first()
    if not n or blank:
        raise ValueError(f"{n} targets, {blank} of them blank")
    return targets


def _given(normalized: bool) -> Callable[[pa.Array], np.ndarray]:
    """Vectors of a slice without nulls, as a matrix, straight from the Arrow buffer."""

    def vectors(part: pa.Array) -> np.ndarray:
        x = part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1).astype(float)
        if not normalized:
            norm = np.linalg.norm(x, axis=1, keepdims=True)
            x /= np.where(norm > 0, norm, 1)
        return x

    return vectors


def _scorer(sent, vectors: Callable[[pa.Array], np.ndarray], nulls: bool):
    """Each slice's best score and target against one broadcast matrix; ``nulls``: whether nulls have vectors, too."""

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matrix, ids = sent.value
        for part in slices(batches, max(1, min(SLICE_ROWS, SLICE_BYTES // (8 * len(matrix))))):
            has = np.ones(len(part), bool) if nulls else part.is_valid().to_numpy(zero_copy_only=False)
            best, where = np.zeros(len(part)), np.zeros(len(part), int)
            if has.any():
                # rounded to 12 digits, so that ties don't hang on the order of summation
                p = np.round(vectors(part if nulls else part.drop_null()) @ matrix.T, 12)
                where[has] = p.argmax(1)
                best[has] = p.max(1)
            yield pa.StructArray.from_arrays([pa.array(best, mask=~has), ids.take(pa.array(where, mask=~has))], ["score", "id"])

    return score


def _best(candidates: DataFrame, targets: DataFrame, column: Column, target_id: str, vector: Column, vectors: Callable[[pa.Array], np.ndarray], nulls: bool) -> DataFrame:
    rows = targets.select(F.col(target_id).alias("i"), vector.alias("v")).where("v IS NOT NULL")
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not n:
        raise ValueError("no targets")
    id_type = targets.schema[target_id].dataType.simpleString()
    parts = max(1, -(-n * width * 8 // PART_BYTES))
    out = candidates
    spark = candidates.sparkSession
    for k in range(parts):
        one = (rows if parts == 1 else rows.where(F.pmod(F.xxhash64("i"), F.lit(parts)) == k)).orderBy("i").toArrow()
        if not one.num_rows:
            continue
        # straight from the Arrow buffer: no Python object for each number
        matrix = one["v"].combine_chunks().flatten().to_numpy().reshape(one.num_rows, -1).astype(float)
        sent = spark.sparkContext.broadcast((matrix, one["i"].combine_chunks()))

        udf = F.arrow_udf(_scorer(sent, vectors, nulls), f"score double, id {id_type}")
        out = out.withColumn(f"__s{k}", udf(column))
    found = F.array_sort(F.array(*(F.struct((-F.col(f"__s{k}.score")).alias("s"), F.col(f"__s{k}.id").alias("id")) for k in range(parts) if f"__s{k}" in out.columns)))[0]
    return out.withColumn("__b", found).select(*(out[c] for c in candidates.columns), (-F.col("__b.s")).alias("similarity_score"), F.col("__b.id").alias("best_target_id"))


def best_targets(candidates: DataFrame, targets: DataFrame, cand_vec: str, target_id: str, target_vec: str, normalized: bool = False) -> DataFrame:
    """All columns of the candidates, ``similarity_score`` and ``best_target_id``: the most similar target by cosine; ties go to the smallest id.

    Targets travel as one matrix per part of bounded size; candidates never move,
    each slice of a batch is one matrix product. A null vector has a null score.
    """
    vector = F.col(target_vec) if normalized else unit(F.col(target_vec))
    return _best(candidates, targets, F.col(cand_vec), target_id, vector, _given(normalized), False)


def best_hashed(candidates: DataFrame, targets: DataFrame, text: str, target_id: str, target_text: str, dim: int = Similarity.dim) -> DataFrame:
    """``best_targets`` by the hash embeddings of two text columns: a candidate's vector is made where it is compared and never leaves the worker."""
    t = hash_embed(targets.select(target_id, target_text), target_text, dim, "__v")
    return _best(candidates, t, F.col(text).cast("string"), target_id, F.col("__v"), lambda part: _text_vectors(part, dim), True)


def top_k(df: DataFrame, k: int, score: str, order: str) -> DataFrame:
    """The k rows of the highest score, ties by the smaller order; sorted. Per-partition heaps and one merge."""
    if k <= 0:
        raise ValueError("k must be positive")
    return df.orderBy(F.col(score).desc_nulls_last(), F.col(order).asc_nulls_last()).limit(k)


def enrich(scored: DataFrame, targets: DataFrame, target_id: str = "id", columns: tuple[str, ...] = ("subject", "split", "target_text"), decimals: int = Similarity.decimals) -> DataFrame:
    """Scores rounded and the best target's columns added as best_target_*; Spark picks the join by the targets' size."""
    t = targets.select(F.col(target_id).alias("best_target_id"), *(F.col(c).alias("best_target_" + c.removeprefix("target_")) for c in columns))
    return scored.withColumn("similarity_score", F.round("similarity_score", decimals)).join(t, "best_target_id", "left")


def rank_scores(scores: Column, how: str = "max", k: int = 3, weights: Column | None = None) -> Column:
    """max, mean of the k highest, or weighted mean of an array of scores."""
    if how == "max":
        return F.array_max(scores)
    if how == "mean_top_k":
        top = F.slice(F.sort_array(scores, False), 1, k)
        return F.aggregate(top, F.lit(0.0), lambda s, x: s + x) / F.size(top)
    total = F.aggregate(weights, F.lit(0.0), lambda s, x: s + x)
    return F.aggregate(F.zip_with(scores, weights, lambda x, w: x * w), F.lit(0.0), lambda s, x: s + x) / total


def composite(similarity: Column, quality: Column, diversity: Column) -> Column:
    return 0.7 * similarity + 0.2 * quality + 0.1 * diversity


def compare_selections(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(only_a, only_b, in_both, jaccard) of two selections' distinct keys."""
    x, y = a.select(key).distinct().withColumn("__a", F.lit(1)), b.select(key).distinct().withColumn("__b", F.lit(1))
    both = x.join(y, key, "full")
    n = both.agg(F.count_if(F.expr("__b IS NULL")).alias("only_a"), F.count_if(F.expr("__a IS NULL")).alias("only_b"), F.count_if(F.expr("__a = 1 AND __b = 1")).alias("in_both"), F.count(F.lit(1)).alias("n"))
    return n.select("only_a", "only_b", "in_both", F.round(F.col("in_both") / F.greatest("n", F.lit(1)), 6).alias("jaccard"))


def score_histogram(df: DataFrame, score: str, width: float = 0.1) -> DataFrame:
    """(low, n): rows by score interval."""
    return df.where(F.col(score).isNotNull()).groupBy(F.round(F.floor(F.col(score) / width) * width, 6).alias("low")).agg(F.count(F.lit(1)).alias("n"))


