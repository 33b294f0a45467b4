"""Quality rules whose cutoffs carry a guarantee: few good documents are rejected in any stratum.

Rule scores of all documents are stored once (numbers only). Labelled documents fall into two folds:

1. The design fold orders cutoffs of all rules into one path, from none to strict, so that each step turns away as many bad
   and as few good documents more as can be (see `fit_path`). A stratum with enough of them has a path of its own.
2. On the other fold, the holdout, each stratum goes along its path while the exact binomial test rejects "the rules
   together turn away more than `risk` of the good documents" at level `error / strata` (Bonferroni over the strata whose
   holdout could pass at all; a fixed order needs no correction within one).

So with probability 1 - error, every stratum loses at most `risk` of its good documents to the rules, whatever the path.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import arrow_map, bucket_of, stored
from .words import _SPACE, mix, windows, words

_WHITE = " \t\n\x0b\x0c\r"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:!?"]] = True
#: Rule scores: name, and the score from the counts of a document. All lie in [0, 1]; a larger one is worse.
RULES = {
    "symbols": "least(1.0D, n_symbols / greatest(n_words, 1))",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "capitals": "least(1.0D, n_upper / greatest(word_chars, 1))",
    "long_words": "least(1.0D, word_chars / greatest(n_words, 1) / 32.0D)",
    "same_words": "1 - n_distinct / greatest(n_words, 1)",
    "stops": "least(1.0D, n_stops / greatest(n_words, 1) / 2.0D)",
}
#: Steps of the grid of cutoffs; a step of a path that is never taken; one in DESIGN labelled rows is of the design fold.
BINS, LATE, DESIGN = 512, 1 << 30, 4
#: Strata up to this number are broadcast with their safe step (some 60 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 100_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_distinct", "n_stops")


def repeated_words(hashes: np.ndarray, doc: np.ndarray, n: int, k: int = 8) -> np.ndarray:
    """For each of n docs, its words that lie in a k-word window found twice or more in it, the first time included."""
    out = np.zeros(n, np.int64)
    w = windows(hashes, k)
    if not len(w):
        return out
    whole = np.flatnonzero(doc[: len(w)] == doc[k - 1 :])
    keys = mix(w[whole] + doc[whole].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, whole[twice], 1)
    np.add.at(cover, whole[twice] + k, -1)
    inside = np.cumsum(cover[:-1]) > 0
    return out + np.bincount(doc[inside], minlength=n)


def duplicate_lines(text: str) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(_WHITE)]
    return len(lines), len(lines) - len(set(lines))


def measure(column) -> dict[str, np.ndarray]:
    """The counts of each whole text of an Arrow string column."""
    out = {name: np.zeros(len(column), np.int64) for name in COUNTS}
    for block in words(column):
        rows = slice(block.first, block.first + block.n)
        per_doc = lambda mask, b=block: np.diff(np.concatenate([[0], np.cumsum(mask)])[b.offsets])
        inner = ~_SPACE[block.data]
        out["n_words"][rows] = np.diff(block.bounds())
        out["word_chars"][rows] = per_doc(inner & ((block.data & 0xC0) != 0x80))
        out["n_symbols"][rows] = per_doc(_SYMBOL[block.data])
        out["n_upper"][rows] = per_doc(_UPPER[block.data])
        out["n_stops"][rows] = per_doc(_STOP[block.data])
        out["n_repeat_words"][rows] = repeated_words(block.hash, block.doc, block.n)
        _, first = np.unique(mix(block.hash + block.doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
        out["n_distinct"][rows] = np.bincount(block.doc[first], minlength=block.n)
    for i, value in enumerate(column):
        text = value.as_py()
        if text:
            out["n_lines"][i], out["n_dup_lines"][i] = duplicate_lines(text)
    return out


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, by Lentz's method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 20_000):
        for t in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + t * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + t / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-14:
            break
    return h


def binomial_at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), exactly up to rounding at any n."""
    if k >= n:
        return 1.0
    a, b, x = n - k, k + 1.0, 1.0 - p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def least_holdout(risk: float, level: float) -> int:
    """Fewest good documents with which the test can pass: with none rejected, (1 - risk) ** n is at most `level`."""
    return max(1, math.ceil(math.log(level) / math.log1p(-risk) - 1e-12))


def choose_step(per_step: np.ndarray, n: int, risk: float, level: float) -> int:
    """How many steps of a path are safe: step s is if few of n good documents are turned away by steps up to it, and all
    before it are. per_step[s]: good documents that step s is the first to turn away."""
    safe, rejected = 0, 0
    for count in per_step:
        rejected += int(count)
        if n == 0 or binomial_at_most(rejected, n, risk) > level:
            break
        safe += 1
    return safe


def fit_path(bins: np.ndarray, good: np.ndarray, worth: float = 1.0) -> np.ndarray:
    """The step of the path at which each rule and bin is turned away (LATE: at none), from a design fold.

    Greedy: of all rules and cutoffs, the one that turns away most bad documents for each good one of those left, midway
    between what goes and what stays, while it is `worth` bad for a good one at least; a move is as many steps as there
    are bins in it. Ties: the first rule, the mildest cutoff.
    """
    out = np.full((bins.shape[1], BINS + 1), LATE, np.int32)
    cutoff, left, step = np.full(bins.shape[1], BINS), np.ones(len(good), bool), 0
    while True:
        best = None
        for r in range(bins.shape[1]):
            counts = np.stack([np.bincount(bins[left & (good == g), r], minlength=BINS + 1) for g in (False, True)])
            bad, fine = counts[:, ::-1].cumsum(1)[:, ::-1]  # turned away if bins from here on are
            value = np.where((counts[0] > 0) & (bad >= worth * fine), bad / (fine + 0.5), 0.0)
            value[0] = 0.0  # bin 0 stays in any case
            at = BINS - int(np.argmax(value[::-1]))
            if value[at] > 0 and (best is None or value[at] > best[0]):
                below = np.flatnonzero(counts[:, :at].sum(0))
                best = (value[at], r, (at + int(below[-1])) // 2 if len(below) else at - 1)
        if best is None:
            return out
        _, r, to = best
        for bin_ in range(int(cutoff[r]), to, -1):
            out[r, bin_], step = step, step + 1
        cutoff[r] = to
        left &= bins[:, r] <= to


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    risk: float = 0.05,
    error: float = 0.05,
    max_design: int = 20_000,
    own_path: int = 100,
    row_col: str | None = None,
) -> DataFrame:
    """One row per input row: id, the counts of its whole text, base_failed, broken (rules that it breaks), kept.

    base_failed: fewer than 20 words, or more than 30 % of the words in repeated 8-word windows. kept: neither base_failed
    nor turned away by a step of the path that is safe in its stratum. All strata are tested, however many; null is a
    stratum like another. Without labels enough for a guarantee nothing is rejected beyond the base. The design fold has at
    most `max_design` labelled rows, those of smallest hash; strata with `own_path` of them have a path of their own, the
    others the path of all.
    A null or empty text has no words and fails the base; repeated rows get a row each; a null id has no label; an empty
    table gives no rows. row_col, a key of rows, is returned too if given. Other columns of docs may have any name. Labels of one id that differ count as not good.
    """

    def counts(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = measure(batch.column(2))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), *(pa.array(got[c]) for c in COUNTS)], ["_id", "_stratum", "_row", *COUNTS])

    spark = docs.sparkSession
    stratum = F.coalesce(F.concat(F.lit("="), F.col(stratum_col).cast("string")), F.lit(""))
    source = docs.select(F.col(id_col).alias("_id"), stratum.alias("_stratum"), F.col(text_col).cast("string").alias("_text"), (F.col(row_col) if row_col else F.lit(None).cast("boolean")).alias("_row"))
    kind, row_kind = (source.schema[c].dataType.simpleString() for c in ("_id", "_row"))
    base = F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")
    rows = stored(arrow_map(source, counts, f"_id {kind}, _stratum string, _row {row_kind}, {', '.join(f'{c} long' for c in COUNTS)}"), "rules")
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_l")).agg((F.min("quality") == 1).alias("_good"))
    bins = F.array(*(_step(score) for score in RULES.values()))
    labelled = stored(rows.where(~base).join(known, F.col("_id") == F.col("_l")).select("_id", "_stratum", bins.alias("_bins"), "_good", (bucket_of(F.col("_id"), DESIGN) == 0).alias("_design")), "labelled")
    paths = spark.sparkContext.broadcast(_paths(labelled.where("_design").orderBy(F.xxhash64("_id"), "_id").limit(max_design), own_path))
    first = F.array_min("_steps").alias("step")
    held = stored(_with_steps(labelled.where("not _design and _good").select("_stratum", "_bins"), paths).groupBy("_stratum", first).count(), "holdout")
    strata = held.groupBy("_stratum").agg(F.sum("count").alias("n")).where(F.col("n") >= least_holdout(risk, error)).count()
    level = error / max(1, strata)

    def choose(table: pa.Table) -> pa.Table:
        step, n = table.column("step").to_numpy(), table.column("count").to_numpy()
        order = np.argsort(step)
        seen = order[step[order] < LATE]
        safe = choose_step(n[seen], int(n.sum()), risk, level)
        # between two steps that holdout documents break, every step is as safe as the first of them
        upto = int(step[seen[safe]]) if safe < len(seen) else LATE
        if binomial_at_most(0, int(n.sum()), risk) > level:
            upto = 0
        return pa.table({"_stratum": table.column("_stratum").slice(0, 1), "_safe": pa.array([upto], pa.int32())})

    safe = stored(held.groupBy("_stratum").applyInArrow(choose, "_stratum string, _safe int"), "safe").withColumnRenamed("_stratum", "_s")
    safe = F.broadcast(safe) if safe.count() <= BROADCAST_ROWS else safe
    judged = _with_steps(rows.select("_id", "_row", "_stratum", *COUNTS, bins.alias("_bins")), paths).join(safe, F.col("_stratum") == F.col("_s"), "left")
    broken = F.array_compact(F.array(*(F.when(F.col("_steps")[i] < F.coalesce("_safe", F.lit(0)), F.lit(name)) for i, name in enumerate(RULES))))
    return judged.select(F.col("_id").alias(id_col), *([F.col("_row").alias(row_col)] if row_col else []), *COUNTS, base.alias("base_failed"), broken.alias("broken")).withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def _step(score: str) -> Column:
    """The grid step of a rule's score."""
    return F.ceil(F.expr(score) * BINS).cast("int")


def _paths(design: DataFrame, own_path: int) -> dict[str | None, np.ndarray]:
    """Paths by stratum, that of all under None; design: _stratum, _bins, _good, bounded."""
    table = design.select("_stratum", "_bins", "_good").toArrow()
    bins = np.array(table.column("_bins").to_pylist(), np.int64).reshape(-1, len(RULES))
    good, stratum = table.column("_good").to_numpy().astype(bool), np.array(table.column("_stratum").to_pylist(), object)
    out = {None: fit_path(bins, good)}
    names, size = np.unique(stratum.astype(str), return_counts=True)
    for name in names[size >= own_path]:
        out[str(name)] = fit_path(bins[stratum == name], good[stratum == name])
    return out


def _with_steps(rows: DataFrame, paths) -> DataFrame:
    """With _steps, of each rule the step of its stratum's path that turns the row away, in place of _bins."""

    def steps(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index("_bins")
        bins = batch.column(at).flatten().to_numpy().reshape(-1, len(RULES))
        code = batch.column(batch.schema.get_field_index("_stratum")).dictionary_encode()
        out, which = np.empty(bins.shape, np.int32), code.indices.to_numpy()
        for i, name in enumerate(code.dictionary.to_pylist()):
            mine = which == i
            out[mine] = paths.value.get(name, paths.value[None])[np.arange(len(RULES)), bins[mine]]
        found = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), len(RULES)).cast(pa.list_(pa.int32()))
        return batch.set_column(at, "_steps", found)

    columns = [f"{f.name} {'array<int>' if f.name == '_bins' else f.dataType.simpleString()}".replace("_bins ", "_steps ") for f in rows.schema]
    return arrow_map(rows, steps, ", ".join(columns))
