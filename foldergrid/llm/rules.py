"""Quality rules whose cutoffs follow the data: per language and source, from quantile sketches.

A sketch is a table of counts per logarithmic bin (exact below 128, else 7 leading bits of the
value, so a quantile is off by 1.6 % at most). Sketches merge by adding counts: those of a
language are the merged ones of its sources, those of everything the merged ones of the languages.
A document fails if a measure lies beyond its group's median by more than SPREADS times the
distance from the lower decile to the median, and by more than an allowance. The lower half is
what the spread is taken from, because junk lies above the median in every measure. A group
with fewer than MIN_ROWS documents uses the sketch of the next wider group that has as many.

Only DataFrame functions are used. Texts are read once, into a table of a few numbers a document;
sketches are summed up before they are shuffled, so a group with most of all rows is a few
thousand counts per task.

Edge cases: a null or empty text has no words and fails the base rules. A null group value is
a group of its own. Repeated rows are judged alike and each counts in the sketches. An empty
table gives an empty result. Very long texts are read whole; 3-word windows are compared by
64-bit hashes. `judge` returns the id and its own columns only, so other columns may have any
names; `keep` uses one name that the table does not have.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldergrid.llm.common import free_name
from foldergrid.operators.lookup import lookup_join
from foldergrid.session import cut_lineage, forget

MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words in windows found twice
MIN_ROWS = 100
SPREADS = 3
EXACT_BITS = 7

# measure: (numerator, denominator, allowance in thousandths, allowance in percent of the median, both sides)
MEASURES = {
    "word_length": ("word_chars", "n_words", 0, 20, True),
    "symbols": ("n_symbols", "n_words", 200, 0, False),
    "dup_lines": ("n_dup_lines", "n_lines", 400, 0, False),
    "repeats": ("n_repeat_words", "n_words", 450, 0, False),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SPACES = r"[\x20\x09-\x0D]+"
_A_WORD = r"[^\x20\x09-\x0D]"
_SYMBOLS = r"[#*$%&|<>]"


def counted(docs: DataFrame, text: str, others: dict[str, Column]) -> DataFrame:
    """`others` and the counts of each text, in three steps so that no array is made twice."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = docs.select(
        *[value.alias(name) for name, value in others.items()],
        F.filter(F.split(whole, _SPACES), lambda w: w != "").alias("_words"),
        F.filter(F.split(whole, "\n"), lambda line: line.rlike(_A_WORD)).alias("_lines"),
        F.regexp_count(whole, F.lit(_SYMBOLS)).cast("bigint").alias("n_symbols"),
    )
    windows = F.expr(
        "if(size(_words) < 3, array(), transform(sequence(0, size(_words) - 3),"
        " i -> xxhash64(_words[i], _words[i + 1], _words[i + 2])))"
    )
    hashed = words.select(
        *others, "n_symbols", F.size("_words").cast("bigint").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("bigint"), lambda n, w: n + F.length(w)).alias("word_chars"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        windows.alias("_windows"),
    )
    # most texts repeat no window: only the others sort theirs
    placed = hashed.select(
        *others, "n_symbols", "n_words", "word_chars", "n_lines", "n_dup_lines",
        F.expr(
            "if(size(array_distinct(_windows)) = size(_windows), cast(array() as array<struct<h: bigint, i: int>>),"
            " array_sort(transform(_windows, (h, i) -> struct(h, i))))"
        ).alias("_sorted"),
    )
    repeated = placed.select(
        *others, "n_symbols", "n_words", "word_chars", "n_lines", "n_dup_lines",
        F.expr(
            "array_sort(transform(filter(_sorted, (x, k) ->"
            " coalesce(x.h = get(_sorted, k - 1).h, false) or coalesce(x.h = get(_sorted, k + 1).h, false)), x -> x.i))"
        ).alias("_at"),
    )
    covered = F.expr(
        "aggregate(_at, struct(0L as n, -3 as last),"
        " (s, i) -> struct(s.n + least(3, i - s.last) as n, i as last), s -> s.n)"
    )
    return repeated.select(*others, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", covered.alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def _value(measure: str) -> Column:
    upper, lower = MEASURES[measure][:2]
    return F.expr(f"1000 * {upper} div {lower}")


def _code(value: str) -> str:
    """Number of a value's bin, ascending with the value."""
    shift = f"greatest(length(bin({value})) - {EXACT_BITS}, 0)"
    return f"{shift} * {1 << EXACT_BITS - 1} + shiftright({value}, {shift})"


def _least(code: str) -> str:
    """The smallest value of a bin."""
    half = 1 << EXACT_BITS - 1
    shift = f"greatest(cast({code} div {half} as int) - 1, 0)"
    return f"shiftleft({code} - {shift} * {half}, {shift})"


def sketches(counts: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, measure, code, n) over all documents that pass the base rules."""
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), _value(m).alias("value")) for m in MEASURES]))
    long = counts.where(~base_failed()).select(*groups, values.alias("_m")).select(*groups, "_m.measure", "_m.value")
    return long.groupBy(*groups, "measure", F.expr(_code("value")).alias("code")).agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, groups: list[str]) -> DataFrame:
    return sketch.groupBy(*groups, "measure", "code").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, groups: list[str], suffix: str) -> DataFrame:
    """Per group and measure the number of documents, lower decile and median."""
    part = Window.partitionBy(*groups, "measure")
    upto = part.orderBy("code").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = sketch.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(part)})
    found = summed.groupBy(*groups, "measure").agg(
        F.max("total").alias("total"),
        F.min(F.when(10 * F.col("upto") >= F.col("total"), F.col("code"))).alias("low"),
        F.min(F.when(2 * F.col("upto") >= F.col("total"), F.col("code"))).alias("mid"),
    )
    return found.select(
        *groups, "measure", F.struct("total", F.expr(_least("low")).alias("low"), F.expr(_least("mid")).alias("mid")).alias(f"_q{suffix}")
    )


def limits(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """One row per group with the bounds `most_<measure>` and `least_<measure>`."""
    levels = [quantiles(merged(sketch, groups[:depth]), groups[:depth], str(depth)) for depth in range(len(groups) + 1)]
    joined = levels[-1]
    for depth in reversed(range(len(groups))):
        joined = joined.join(levels[depth], [*groups[:depth], "measure"])
    wide_enough = [F.when(F.col(f"_q{d}.total") >= MIN_ROWS, F.col(f"_q{d}")) for d in reversed(range(1, len(groups) + 1))]
    chosen = joined.select(*groups, "measure", F.coalesce(*wide_enough, F.col("_q0")).alias("q"))
    bounds = []
    for measure, (_, _, flat, percent, both) in MEASURES.items():
        mine = F.col("measure") == measure
        reach = F.greatest(SPREADS * (F.col("q.mid") - F.col("q.low")), F.lit(flat), F.expr(f"{percent} * q.mid div 100"))
        bounds.append(F.max(F.when(mine, F.col("q.mid") + reach)).alias(f"most_{measure}"))
        if both:
            bounds.append(F.max(F.when(mine, F.col("q.mid") - reach)).alias(f"least_{measure}"))
    return chosen.groupBy(*groups).agg(*bounds)


def within() -> Column:
    """Whether every measure lies within the bounds of the document's group."""
    tests = []
    for measure, (_, _, _, _, both) in MEASURES.items():
        tests.append(_value(measure) <= F.col(f"most_{measure}"))
        if both:
            tests.append(_value(measure) >= F.col(f"least_{measure}"))
    return reduce(and_, tests)


def _group_key(value: Column) -> Column:
    """A group value as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def _judged(docs: DataFrame, text: str, by: tuple[str, ...], others: dict[str, Column]) -> DataFrame:
    groups = [f"_group{i}" for i in range(len(by))]
    keys = {name: _group_key(F.col(f"`{column}`")) for name, column in zip(groups, by)}
    counts = cut_lineage(counted(docs, f"`{text}`", {**others, **keys}))
    sketch = cut_lineage(sketches(counts, groups))
    joined = lookup_join(counts, limits(sketch, groups), groups, [*COUNTS])
    forget(sketch)
    failed = base_failed()
    kept = F.when(failed, False).otherwise(F.coalesce(within(), F.lit(True)))
    return joined.select(*others, *COUNTS, failed.alias("base_failed"), kept.alias("kept"))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Per document its id, the counts, `base_failed` and `kept`. `by` names the group columns
    from the widest to the narrowest."""
    judged = _judged(docs, text, by, {"_doc": F.col(f"`{doc_id}`")})
    return judged.withColumnRenamed("_doc", doc_id)


def keep(docs: DataFrame, text: str = "text", by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """The documents that pass, as they are: the verdicts are joined to the written rows' own numbers."""
    number = free_name(docs, "row")
    numbered = cut_lineage(docs.withColumn(number, F.monotonically_increasing_id()))
    judged = _judged(numbered, text, by, {"_doc": F.col(number)}).where("kept").select(F.col("_doc").alias(number))
    return numbered.join(judged, number, "left_semi").drop(number)
