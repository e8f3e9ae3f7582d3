"""Which template page a scanned page is: costs, assignments, their confidence, and the stages that try them in turn.

Costs are rows `doc, page, template, cost`; a document has at most as many as its pages times its questionnaire's
template pages, so a document is a bounded group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.assignment import assign

# No second choice, and the thresholds of hashes and of texts.
NO_SECOND = 1_000_000_000
HASH_GAP, HASH_MOST = 5, 18
TEXT_GAP, TEXT_MOST, TEXT_DISCARD = 0.1, 0.2, 0.7


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def hash_costs(pages: DataFrame, templates: DataFrame, q: str = "q") -> DataFrame:
    """Distances of hashes between a document's pages and the templates of its questionnaire."""
    t = templates.select(q, "template", F.col("hash").alias("_h"))
    return pages.join(t, q).select("doc", "page", "template", hamming(F.col("hash"), F.col("_h")).cast("double").alias("cost"))


def assign_pages(costs: DataFrame) -> DataFrame:
    """`doc, page, template, cost`: the pairs of least total cost, as many as the fewer of pages and templates. Pairs without a
    cost are the last resort; null keys are left out, and of repeated pairs the least cost counts."""

    def solve(entries: list[dict]) -> list[dict]:
        least: dict[tuple, float] = {}
        for e in entries:
            at = e["page"], e["template"]
            least[at] = min(e["cost"], least.get(at, e["cost"]))
        pages, templates = sorted({p for p, _ in least}), sorted({t for _, t in least})
        values = np.array([[least.get((p, t), np.nan) for t in templates] for p in pages])
        worst = np.nanmax(values) if np.isfinite(values).any() else 0.0
        filled = np.where(np.isnan(values), abs(worst) * 2 * (1 + min(values.shape)) + 1, values)
        return [{"page": pages[r], "template": templates[c], "cost": values[r, c]} for r, c in assign(filled) if not np.isnan(values[r, c])]

    def run(batches):
        for batch in batches:
            solved = [solve(x) for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(solved, batch.column(1).type)], names=["doc", "pairs"])

    rows = costs.dropna(subset=["doc", "page", "template", "cost"]).select("doc", F.struct("page", "template", F.col("cost").cast("double").alias("cost")).alias("pair"))
    kind = rows.schema["pair"].dataType.simpleString()
    # Many documents go to Python in one batch.
    solved = rows.groupBy("doc").agg(F.collect_list("pair").alias("pairs")).mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, pairs array<{kind}>")
    return solved.select("doc", F.explode("pairs").alias("p")).select("doc", "p.page", "p.template", "p.cost")


def report(costs: DataFrame, assigned: DataFrame, gap: float = HASH_GAP, most: float = HASH_MOST, whole: bool = True) -> DataFrame:
    """Each assigned page's best and second cost, their gap, the chosen cost, and whether both tests hold.

    `whole` cuts costs to whole numbers before they are compared, which makes costs below 1 equal.
    """
    cost = F.col("cost").cast("long") if whole else F.col("cost")
    rank = F.row_number().over(Window.partitionBy("doc", "page").orderBy("cost", "template"))
    two = costs.withColumn("_n", rank).where("_n <= 2").groupBy("doc", "page").agg(F.min(cost).alias("best"), F.max(F.when(F.col("_n") == 2, cost)).alias("_second"))
    rows = assigned.join(two, ["doc", "page"])
    second = F.coalesce("_second", F.lit(NO_SECOND))
    out = rows.select("doc", "page", "template", "best", second.alias("second_best"), (second - F.col("best")).alias("gap"), cost.alias("chosen"))
    return out.withColumn("ok", (F.col("gap") >= gap) & (F.col("chosen") <= most))


def report_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("doc").agg(F.count("*").alias("n_pages"), F.sum("chosen").alias("total_cost"), F.avg("chosen").alias("mean_cost"), F.bool_and("ok").alias("confident"))


def select_template(totals: DataFrame) -> DataFrame:
    """`doc, variant` of least total cost, the first of ties, from rows `doc, variant, position, total`."""
    return totals.groupBy("doc").agg(F.min_by("variant", F.struct("total", "position")).alias("variant"))


def square_variant(pages: DataFrame, square: str, other: str, tolerance: float = 0.1) -> DataFrame:
    """`doc, variant`: one for documents with a nearly square page, another for the rest."""
    ratio = F.abs(F.col("width") - F.col("height")) / F.greatest("width", "height")
    return pages.groupBy("doc").agg(F.when(F.bool_or(ratio < tolerance), square).otherwise(other).alias("variant"))


def discover(matches: DataFrame) -> DataFrame:
    """`doc, variant, template` of the most good matches, the first of ties; documents without any are left out."""
    best = matches.groupBy("doc").agg(F.max_by(F.struct("variant", "template", "n_good"), F.struct("n_good", (-F.col("position")).alias("p"))).alias("b"))
    return best.where("b.n_good > 0").select("doc", "b.variant", "b.template")


def disagreements(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pages that two assignments place apart, or that one leaves out."""
    x, y = a.select("doc", "page", F.col("template").alias("first")), b.select("doc", "page", F.col("template").alias("second"))
    return x.join(y, ["doc", "page"], "full").where(~F.col("first").eqNullSafe(F.col("second")))


def by_position(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """Pairs of the n-th page and the n-th template of each document, as far as both go."""
    n = lambda df, c: df.withColumn("_n", F.row_number().over(Window.partitionBy("doc").orderBy(c)))
    return n(pages, "page").join(n(templates, "template"), ["doc", "_n"]).select("doc", "page", "template")


def cascade(pages: DataFrame, templates: DataFrame, verified: DataFrame, stage2: DataFrame, stage3: DataFrame, most: float = TEXT_MOST) -> DataFrame:
    """`doc, page, template, stage, cost, warned` of all pages that some stage places.

    First the n-th page is held against the n-th template; what `verified` (doc, page, template) doesn't hold goes on. Then the rest is
    assigned by `stage2` costs, and verified again. Then what is left is assigned by `stage3` costs, and warned of
    where they are above `most`. Each stage sees only what the ones before left.
    """
    key = ["doc", "page", "template"]
    first = by_position(pages, templates).join(verified.select(*key).distinct(), key, "left_semi")

    def left(costs: DataFrame, *placed: DataFrame) -> DataFrame:
        for p in placed:
            costs = costs.join(p.select("doc", "page"), ["doc", "page"], "left_anti").join(p.select("doc", "template"), ["doc", "template"], "left_anti")
        return costs

    second = assign_pages(left(stage2, first)).join(verified.select(*key).distinct(), key, "left_semi")
    third = assign_pages(left(stage3, first, second))
    none, no = F.lit(None).cast("double"), F.lit(False)
    return (
        first.select(*key, F.lit(1).alias("stage"), none.alias("cost"), no.alias("warned"))
        .unionByName(second.select(*key, F.lit(2).alias("stage"), F.col("cost").cast("double").alias("cost"), no.alias("warned")))
        .unionByName(third.select(*key, F.lit(3).alias("stage"), F.col("cost").cast("double").alias("cost"), (F.col("cost") > most).alias("warned")))
    )


def matched_templates(pairs: DataFrame, least: int = 2) -> DataFrame:
    """`doc, page, template` of pages with enough alignment boxes found; of several templates the last pair's.

    `pairs` has a row per box: doc, page, template, position, matched.
    """
    per = pairs.groupBy("doc", "page", "template").agg(F.count_if(F.col("matched")).alias("n"), F.max("position").alias("position")).where(F.col("n") >= least)
    return per.groupBy("doc", "page").agg(F.max_by("template", "position").alias("template"))


def expected_pages(files: DataFrame, questionnaires: DataFrame) -> DataFrame:
    """Pages to take of each document's files: `doc, position, file, page_index`.

    `files` has doc, q, file and n_pages (0 if it can't be opened); `questionnaires` has q, num_pages and reverse. The largest
    file of several pages is taken whole, the first by name of ties, backwards where the questionnaire's order is not alphabetical; single pages
    follow, in that order of names, if it has fewer pages than expected. Documents without a file that opens give no rows.
    """
    f = files.where("n_pages > 0").join(F.broadcast(questionnaires), "q")
    up = F.row_number().over(Window.partitionBy("doc").orderBy("file"))
    ranked = f.withColumn("_up", up).withColumn("_at", F.when(F.col("reverse"), -F.col("_up")).otherwise(F.col("_up")))
    big = ranked.where("n_pages > 1").groupBy("doc").agg(F.max_by(F.struct("file", "n_pages", "reverse"), F.struct("n_pages", (-F.col("_at")).alias("a"))).alias("b"))
    taken = big.select("doc", "b.file", "b.reverse", "b.n_pages", F.posexplode(F.sequence(F.lit(0), F.col("b.n_pages") - 1)).alias("j", "k"))
    many = taken.select("doc", F.lit(0).alias("part"), F.col("j").alias("k"), "file", F.when(F.col("reverse"), F.col("n_pages") - 1 - F.col("j")).otherwise(F.col("j")).alias("page_index"))
    singles = ranked.where("n_pages = 1").join(big.select("doc", F.col("b.n_pages").alias("_have")), "doc", "left").where(F.coalesce("_have", F.lit(0)) < F.col("num_pages"))
    ones = singles.select("doc", F.lit(1).alias("part"), F.col("_at").alias("k"), "file", F.lit(0).alias("page_index"))
    return many.unionByName(ones).select("doc", F.row_number().over(Window.partitionBy("doc").orderBy("part", "k")).alias("position"), "file", "page_index")


#: Fixed values of the thirteen questionnaires: pages expected, whether pages come in reverse order of names, one file per page.
QUESTIONNAIRES = {
    1: (4, False, False),
    2: (8, True, False),
    3: (2, False, False),
    4: (4, True, False),
    5: (4, True, False),
    6: (4, False, False),
    7: (5, False, False),
    8: (32, False, True),
    9: (4, False, False),
    10: (12, False, True),
    11: (8, False, True),
    12: (12, False, True),
    13: (20, False, True),
}
#: Questionnaires with two template layouts.
VARIANTS = {1: 2, 8: 2}


def questionnaires(spark) -> DataFrame:
    return spark.createDataFrame([(q, n, r, s, VARIANTS.get(q, 1)) for q, (n, r, s) in QUESTIONNAIRES.items()], "q int, num_pages int, reverse boolean, single boolean, n_variants int")
