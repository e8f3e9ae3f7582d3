"""Splits that keep records together that share a subject, a group or other records with one."""

from __future__ import annotations

from collections.abc import Hashable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import hot_keys, replicated, salted
from ..session import cut, forget


#: An entity with more than this part of all links is divided.
SHARE = 1 / 4096


def _mixed(c: Column) -> Column:
    """A whole number in an order without relation to the numbers' own; different ones stay different, as each step can be undone."""
    for _ in range(2):
        c = c.bitwiseXOR(F.shiftleft(c, 13))
        c = c.bitwiseXOR(F.shiftrightunsigned(c, 7))
        c = c.bitwiseXOR(F.shiftleft(c, 17))
    return c


def divided(links: DataFrame, share: float = SHARE, least: int = 1000) -> DataFrame:
    """`label, entity` in which no entity has more than about `share` of all links: of one with more, each part has an entity of
    its own, and one node of each part keeps the link to the entity itself."""
    bound = max(least, links.count() * share)
    hot = links.groupBy("entity").agg(F.count("*").alias("n")).where(F.col("n") > bound)
    found = hot.select("entity", F.ceil(F.col("n") / bound).alias("parts")).collect()  # fewer than 1 / share rows
    if not found:
        return links
    hot = links.sparkSession.createDataFrame(found, "entity string, parts long")
    parts = links.join(F.broadcast(hot), "entity", "left").withColumn("part", F.pmod(F.xxhash64("label"), F.col("parts")))
    part = F.when(F.col("part").isNull(), F.col("entity")).otherwise(F.concat_ws("\0", "entity", F.col("part").cast("string")))
    kept = parts.where("part IS NOT NULL").groupBy("entity", "part").agg(F.min("label").alias("label"))
    return parts.select("label", part.alias("entity")).unionByName(kept.select("label", "entity"))


def connected(records: DataFrame, record_id: str, entities: Sequence[Column], most_rounds: int = 60) -> DataFrame:
    """`record_id, set_id`: the smallest record id that a record reaches over shared entities.

    Labels go from records to entities and back: each round, every label takes the least label of its entities. Records of
    one label are from then on one, and entities with a single label are done, so that the links left shrink by half or more each
    round, those of a chain too, as labels have a random order. The labels' steps are put together at the end. Entities and labels with many links are divided or broadcast. Each
    round is written to the shared folder. Records without any entity are sets of their own; records with a null id are left
    out; repeated ids are one record. More than `most_rounds` rounds raise an error, which would take some 2 ** `most_rounds` records.
    """
    keys = F.array_distinct(F.array_compact(F.array(*entities)))
    rows = records.where(F.col(record_id).isNotNull()).select(F.col(record_id).cast("long").alias("record_id"), keys.alias("keys"))
    links = divided(cut(rows.select(_mixed(F.col("record_id")).alias("label"), F.explode("keys").alias("entity"))))
    steps: list[tuple[DataFrame, int]] = []
    last = None
    while len(steps) <= most_rounds:
        own = Window.partitionBy("entity")
        least = links.repartition("entity").dropDuplicates(["label", "entity"]).withColumns({"low": F.min("label").over(own), "high": F.max("label").over(own)})
        active = cut(least.where("low < high").select("label", "entity", "low"))
        n = active.count()
        if last is not None:
            forget(last)
        last = active
        if not n:
            break
        step = cut(active.groupBy("label").agg(F.min("low").alias("to"), F.count("*").alias("n")))
        steps.append((step.select("label", "to"), n))
        moved = lambda rows, to: rows.join(to, "label").select(F.col("to").alias("label"), "entity")
        if n <= 1000:
            links = moved(active, step)
            continue
        hot = F.broadcast(step.where(F.col("n") > max(1000, n * SHARE)))  # fewer than 1 / SHARE rows
        links = moved(active, hot).unionByName(moved(active.join(hot.select("label"), "label", "left_anti"), step))
    else:
        raise RuntimeError(f"labels still change after {most_rounds} rounds")
    ends = None
    for step, n in reversed(steps):
        beyond = None if ends is None else ends.select(F.col("label").alias("to"), F.col("to").alias("end"))
        ends = step if beyond is None else joined(step, beyond, "to", F.col("label"), "left", n).select("label", F.coalesce("end", "to").alias("to"))
    rooted = rows.select("record_id").distinct().withColumn("label", _mixed(F.col("record_id")))
    rooted = rooted.withColumn("root", F.col("label")) if ends is None else rooted.join(ends, "label", "left").withColumn("root", F.coalesce("to", "label"))
    rooted = cut(rooted.select("record_id", "root"))
    return joined(rooted, rooted.groupBy("root").agg(F.min("record_id").alias("set_id")), "root", F.col("record_id"), "inner").select("record_id", "set_id")


def joined(left: DataFrame, right: DataFrame, key: str, spread: Column, how: str, rows: int = 1 << 62) -> DataFrame:
    """A join with a side of one row per key, in which the other side's hot keys, if it has any, are spread. `rows` bounds that side's, where known."""
    found = hot_keys(left, [key]).collect() if rows > 1000 else []  # fewer than 256 rows
    if not found:
        return left.join(right, key, how)
    hot = left.sparkSession.createDataFrame(found, left.select(key).schema.add("_hot", "boolean"))
    return salted(left, [key], hot, spread).join(replicated(right, [key], hot), [key, "_salt"], how).drop("_salt")


def split_name(c: Column) -> Column:
    """train, val or test in any spelling; null for anything else."""
    name = F.lower(F.regexp_replace(c, r"[\s_\-.]+", ""))
    return F.when(name.isin("train", "training"), "train").when(name.isin("val", "validation", "valid"), "val").when(name.isin("test", "testing"), "test")


def divided_sets(members: DataFrame, given: DataFrame, record_id: str, split: Column) -> DataFrame:
    """`record_id, set_id` of every record of a set whose given splits, nulls aside, are more than one."""
    named = given.select(F.col(record_id).cast("long").alias("record_id"), split.alias("split")).where("split IS NOT NULL")
    sets = members.join(named, "record_id").groupBy("set_id").agg(F.min("split").alias("a"), F.max("split").alias("b")).where("a <> b").select("set_id")
    return joined(members, sets, "set_id", F.col("record_id"), "left_semi").select("record_id", "set_id")


def dealt(pieces: Sequence[tuple[Hashable, int, Mapping[str, int]]], shares: Mapping[str, float], labels: Mapping[str, int], total: int) -> dict[Hashable, str]:
    """A split for each piece (key, records, records by label), the largest first, of the splits with room for half of it (or else the
    emptiest) each to where the squared deviations of size and labels from what the splits are due, as parts of that, come out least."""
    short = {s: {None: -share * total} | {k: -share * n for k, n in labels.items()} for s, share in shares.items()}
    out = {}
    for key, n, parts in sorted(pieces, key=lambda p: (-p[1], p[0])):
        adds = [(None, n, total)] + [(k, x, labels[k]) for k, x in parts.items() if k in labels]
        gain = {s: sum(x * (2 * short[s][k] + x) / of**2 for k, x, of in adds) / max(share, 1e-9) for s, share in shares.items()}
        room = [s for s in shares if short[s][None] + n / 2 <= 0] or [min(shares, key=lambda s: (short[s][None], s))]
        best = out[key] = min(room, key=lambda s: (gain[s], s))
        for k, x, _ in adds:
            short[best][k] += x
    return out


def assign_splits(members: DataFrame, label: DataFrame, shares: Mapping[str, float], big: int = 1000, seed: int = 42, most_labels: int = 10_000) -> DataFrame:
    """`set_id, split` that give each split its share of the records and of each label, as near as undivided sets allow.

    `label` has record_id and label; null is a label, and more than `most_labels` raise an error. Sets of more than 1/`big` of all records, fewer than
    `big`, are dealt out one by one. The others go in blocks of like label counts and size, drawn by hash: a set or about 1/(4 `big`) of all
    records, a few for each kind at least. All are dealt by what each split still lacks of the records and of each label.
    """
    labelled = members.join(label.groupBy("record_id").agg(F.min("label").alias("label")), "record_id", "left")
    counts = labelled.groupBy("set_id", F.coalesce(F.col("label").cast("string"), F.lit("")).alias("label")).agg(F.count("*").alias("n"))
    sets = cut(counts.groupBy("set_id").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("label", "n"))).alias("labels")))
    total = sets.agg(F.sum("n")).first()[0] or 0
    limit = total / big
    each = sets.select(F.explode("labels").alias("x")).select("x.*")
    labels = {r.label: r.n for r in each.groupBy("label").agg(F.sum("n").alias("n")).limit(most_labels + 1).collect()}
    if len(labels) > most_labels:
        raise ValueError(f"more than {most_labels} labels")
    signature = F.transform("labels", lambda x: F.concat_ws(":", x["label"], F.least(x["n"], F.lit(4)).cast("string")))
    kind = F.pmod(F.xxhash64(F.concat_ws("|", signature), F.floor(F.log2(F.col("n")))), F.lit(512))
    rest = sets.where(F.col("n") <= limit).withColumn("kind", kind)
    parts = rest.groupBy("kind").agg((F.ceil(F.sum("n") * (4 * big / max(1, total))) + 31).alias("parts"))
    rest = rest.join(F.broadcast(parts), "kind").withColumn("part", F.pmod(F.xxhash64("set_id", F.lit(seed)), F.col("parts")))
    in_blocks = rest.select("kind", "part", F.explode("labels").alias("x")).groupBy("kind", "part", "x.label").agg(F.sum("x.n").alias("n"))
    blocks = in_blocks.groupBy("kind", "part").agg(F.sum("n").alias("n"), F.collect_list(F.struct("label", "n")).alias("labels"))
    giants = sets.where(F.col("n") > limit)
    pieces = [((0, r.set_id), r.n, {x.label: x.n for x in r.labels}) for r in giants.collect()]
    pieces += [((1, r.kind, r.part), r.n, {x.label: x.n for x in r.labels}) for r in blocks.collect()]
    chosen = dealt(pieces, shares, labels, total)
    make = members.sparkSession.createDataFrame
    of_blocks = make([(*k[1:], s) for k, s in chosen.items() if k[0] == 1], "kind long, part long, split string")
    of_giants = make([(k[1], s) for k, s in chosen.items() if k[0] == 0], "set_id long, split string")
    return rest.join(F.broadcast(of_blocks), ["kind", "part"]).select("set_id", "split").unionByName(of_giants)
