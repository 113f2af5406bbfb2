"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Whole epochs of a source come first. What remains of its target is filled by
its documents in the order of their keys -ln(u) / w, where u is a uniform hash
of the document and w its quality weight, until the words reach the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packetflow.llm.common import read_table, written

WEIGHTS = (3.0, 1.0, 2.0)   # of the sources in order, repeating
SHARE = 1.5                 # of all sizes that the mix holds
MAX_EPOCHS = 2.0            # no source is taken more often
BINS = 4096                 # ranges of keys that are summed before single documents are looked at
SEED = 42


def word_count(text: Column) -> Column:
    """Number of runs of characters other than blank and \\x09-\\x0D."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Between 0.05 and 1: the share of letters, blanks and line ends in the text, squared."""
    plain = F.length(F.regexp_replace(text, r"[^\p{L}\s]+", ""))
    share = plain / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.coalesce(share * share, F.lit(0.0)), F.lit(0.05))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
            max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row a source.

    Sources rank by code point, null last, and take the weights in turn.
    Water-filling: with the level t = target / weight, a source is full once
    t * weight reaches its limit. In the order of limit / weight, the full ones
    are a prefix, so the level follows from running sums.
    """
    ranked = sizes.agg(F.sort_array(F.collect_list(F.struct(
        F.col("source").isNull().alias("none"), F.col("source"),
        F.col("source_size")))).alias("all"), F.sum("source_size").alias("total"))
    cycle = F.array(*map(F.lit, weights))
    one = ranked.select("total", F.posexplode("all").alias("place", "s")).select(
        "total", F.col("s.source").alias("source"), F.col("s.source_size").alias("source_size"),
        F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("s.source_size") * F.lit(max_epochs)).alias("limit"))
    # Sources are few (a name each); they are ordered in one small array, not in a window.
    filled = one.agg(F.sort_array(F.collect_list(F.struct(
        (F.col("limit") / F.col("weight")).alias("full_at"), "source", "source_size", "weight",
        "limit"))).alias("all"), (F.first("total") * F.lit(share)).alias("budget"))
    level = F.expr("""
        aggregate(all, named_struct('left', budget, 'weight', aggregate(all, 0D, (a, x) -> a + x.weight),
                                    'level', CAST(NULL AS DOUBLE)),
          (a, x) -> CASE WHEN a.level IS NOT NULL THEN a
                         WHEN x.full_at * a.weight >= a.left
                         THEN named_struct('left', a.left, 'weight', a.weight, 'level', a.left / a.weight)
                         ELSE named_struct('left', a.left - x.limit, 'weight', a.weight - x.weight,
                                           'level', a.level) END).level""")
    return (filled.select(level.alias("level"), F.explode("all").alias("s"))
            .select("s.source", "s.source_size", F.when(
                F.col("level").isNull(), F.col("s.limit")).otherwise(
                F.least(F.col("s.limit"), F.col("level") * F.col("s.weight"))).alias("target")))


def mix(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
        max_epochs: float = MAX_EPOCHS, bins: int = BINS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every row of `docs`.

    A document is taken whole, `copies` times; `taken` is copies times size.
    The last document taken in a source is the one whose middle is within the
    budget, so a source misses its target by half a document at most.
    Null texts have no words; null sources form one source, after all others.
    Equal rows have equal keys and are ordered by id, then arbitrarily; they
    add the same either way. An empty table gives no rows.

    A source is never ordered as a whole: its keys fall into ranges that are
    summed first (`bins` rows a source), and only the range in which the budget
    ends is ordered by document.
    """
    text = F.col(f"`{text_col}`")
    u = (F.xxhash64(F.col(f"`{id_col}`"), text, F.lit(seed)).bitwiseAND(
        F.lit((1 << 53) - 1)) + F.lit(0.5)) / F.lit(float(1 << 53))
    key = -F.log(u) / quality_weight(text)
    sized = written(spark, docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        word_count(text).alias("size"), key.alias("key")), "mix-keys")
    # The ranges keep apart the small keys of good documents and the large ones of poor ones.
    sized = sized.withColumn("bin", F.floor(F.col("key") / (F.col("key") + 3) * bins).cast("int"))

    by_bin = written(spark, sized.groupBy("source", "bin").agg(F.sum("size").alias("words")),
                     "mix-bins")
    wanted = targets(by_bin.groupBy("source").agg(F.sum("words").alias("source_size")),
                     weights, share, max_epochs)
    wanted = wanted.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(
        F.col("target") / F.col("source_size"))).otherwise(0)).withColumn(
        "budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    # Of each source: the first range that the budget doesn't cover, and the words before it.
    running = by_bin.groupBy("source").agg(F.sort_array(F.collect_list(
        F.struct("bin", "words"))).alias("bins"))
    cut = (running.join(wanted, running["source"].eqNullSafe(wanted["source"])).drop(running["source"])
           .withColumn("cut", F.expr("""
               aggregate(bins, named_struct('before', 0L, 'bin', CAST(NULL AS INT)),
                 (a, x) -> CASE WHEN a.bin IS NOT NULL THEN a
                                WHEN a.before + x.words > budget
                                THEN named_struct('before', a.before, 'bin', x.bin)
                                ELSE named_struct('before', a.before + x.words, 'bin', a.bin) END)"""))
           .select(F.col("source").alias("of"), "source_size", "target", "epochs", "budget",
                   F.col("cut.bin").alias("cut_bin"), F.col("cut.before").alias("before")))
    cut = written(spark, cut, "mix-cuts")
    placed = sized.join(cut, sized["source"].eqNullSafe(cut["of"]))
    inside = F.col("bin") < F.coalesce("cut_bin", F.lit(bins + 1))
    at_cut = F.coalesce(F.col("bin") == F.col("cut_bin"), F.lit(False))
    order = (Window.partitionBy("source").orderBy("key", "doc_id")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edge = placed.where(at_cut).withColumn(
        "end", F.col("before") + F.sum("size").over(order))
    last = F.col("end") - F.col("size") / 2 <= F.col("budget")
    copies = F.col("epochs").cast("long")
    columns = ["doc_id", "source", "size", "source_size", "target"]
    return (placed.where(~at_cut).select(*columns, (copies + inside.cast("long")).alias("copies"))
            .unionByName(edge.select(*columns, (copies + last.cast("long")).alias("copies")))
            .withColumn("taken", F.col("copies") * F.col("size")))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, source size, target and words taken of every document."""
    return mix(spark, read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source")
