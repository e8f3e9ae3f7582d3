"""Schemas that drift from file to file: profiles, renames by matching, a report and one consistent table."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import partial
from hashlib import blake2b
from heapq import heappush, heappushpop

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from ..functions import strict_json
from ..functions.assignment import assign
from ..session import cut
from .skew import hot_keys, replicated, salted

#: Distinct values kept of a field in a file, those with the least hashes; values kept of it over all files, of numbers one for
#: each file that has it, so that their distribution shows; characters of a value kept beside its hash.
SKETCH, COMMON, LONGEST = 64, 256, 60
#: Greatest distance of two distributions of numbers that is put down to chance, however many values there are.
APART = 0.3
#: Least similarity of a lost and a new field that counts as a rename.
SIMILAR = 0.55
KINDS = ("string", "number", "boolean", "array", "object")
#: Bits above those of KINDS: a value or an array's entry is a text that is no number; an array's entry is an array or object.
TEXT, DEEP = 32, 64
#: Rows that are broadcast at most, of some 100 bytes each.
FEW = 1 << 18


def kind_of(value) -> int:
    """Position in KINDS of a JSON value other than null."""
    return 2 if isinstance(value, bool) else 0 if isinstance(value, str) else 1 if isinstance(value, int | float) else 3 if isinstance(value, list) else 4


def bits_of(value) -> int:
    """The bit of a value's kind, with TEXT and DEEP."""
    kind = kind_of(value)
    out = 1 << kind
    if kind == 1:
        return out
    for v in value if kind == 3 else (value,):
        if isinstance(v, bool) or isinstance(v, str) and _number(v) is None:
            out |= TEXT
        elif kind == 3 and isinstance(v, list | dict):
            out |= DEEP
    return out


def fields_of(record: dict, nested: tuple[str, ...]) -> Iterator[tuple[str, int, object]]:
    """(path, position, value) of a record's fields and of those of the entries of `nested` ones; nulls left out."""
    for k, (name, value) in enumerate(record.items()):
        if value is None:
            continue
        yield name, k, value
        if name in nested:
            for entry in value if isinstance(value, list) else [value]:
                for j, (part, v) in enumerate(entry.items() if isinstance(entry, dict) else ()):
                    if v is not None:
                        yield f"{name}.{part}", j, v


def leaves(value) -> Iterator[str]:
    """The scalars of a value, as texts, other than the fields that have paths of their own."""
    if isinstance(value, str):
        yield value if len(value) <= LONGEST else f"{value[:LONGEST]}\0{blake2b(value.encode('utf-8', 'surrogatepass'), digest_size=12).hexdigest()}"
    elif isinstance(value, list):
        for v in value:
            yield from leaves(v)
    elif isinstance(value, dict):
        for v in value.values():
            yield from leaves(v)
    elif value is not None:
        yield json.dumps(value) if isinstance(value, bool) else repr(value)


def hash_of(text: str) -> int:
    return xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


class _Sketch:
    """The `size` distinct texts of least hash: those of a union follow from those of its parts, in any order."""

    __slots__ = ("size", "heap", "held")

    def __init__(self, size: int = SKETCH) -> None:
        self.size = size
        self.heap: list[tuple[int, str]] = []
        self.held: set[str] = set()

    def add(self, text: str) -> None:
        if text not in self.held:
            item = (-hash_of(text), text)
            if len(self.heap) < self.size:
                heappush(self.heap, item)
                self.held.add(text)
            elif item > self.heap[0]:
                self.held.discard(heappushpop(self.heap, item)[1])
                self.held.add(text)

    def texts(self) -> list[str]:
        return sorted(self.held)


class _Field:
    """Profile of a field: kinds, holders, sum of positions, and a sketch of its distinct values."""

    __slots__ = ("kinds", "n", "place", "sketch")

    def __init__(self, size: int = SKETCH) -> None:
        self.kinds = self.n = self.place = 0
        self.sketch = _Sketch(size)

    def merge(self, other: dict) -> None:
        self.kinds, self.n, self.place = self.kinds | other["kinds"], self.n + other["n"], self.place + other["place"]
        for text in other["sample"]:
            self.sketch.add(text)

    def row(self, path: str) -> dict:
        return {"path": path, "kinds": self.kinds, "n": self.n, "place": self.place, "sample": self.sketch.texts()}


FIELDS = "array<struct<path:string,kinds:int,n:long,place:long,sample:array<string>>>"
_FIELDS = pa.list_(pa.struct([("path", pa.string()), ("kinds", pa.int32()), ("n", pa.int64()), ("place", pa.int64()), ("sample", pa.list_(pa.string()))]))


def _sorted_fields(fields: dict[str, _Field]) -> list[dict]:
    return [fields[p].row(p) for p in sorted(fields)]


def _merged(batches, size: int = SKETCH):
    """Rows of a key and lists of fields, as one row of the key and merged fields."""
    for batch in batches:
        out = []
        for lists in batch.column(1).to_pylist():
            fields: dict[str, _Field] = {}
            for field in (f for x in lists for f in x):
                fields.setdefault(field["path"], _Field(size)).merge(field)
            out.append(_sorted_fields(fields))
        yield pa.record_batch([batch.column(0), pa.array(out, _FIELDS)], names=["file_no", "fields"])


def files_of(records: DataFrame) -> DataFrame:
    """`file_no, stream, exported_at, n` of each file; rows without a file number are left out."""
    return records.where(F.col("file_no").isNotNull()).groupBy(F.col("file_no").cast("long").alias("file_no")).agg(F.min("stream").alias("stream"), F.min("exported_at").alias("exported_at"), F.count("*").alias("n"))


def profile(records: DataFrame, files: DataFrame, nested: tuple[str, ...] = ("label",)) -> tuple[DataFrame, DataFrame]:
    """Profiles of each file, `file_no, fields`, and of each field over all files, `path, common`.

    Records are shuffled once, by file, and a task profiles a file after the other. Files with more than 1/256 of all
    records, fewer than 256 of them, are spread over 64 parts each, whose profiles are merged. The values over all files
    are the texts of least hash, whatever the partitions. Records that are no JSON objects count as empty.
    """
    rows = records.where(F.col("file_no").isNotNull()).select(F.col("file_no").cast("long").alias("file_no"), F.col("record").cast("string").alias("record"))
    total = files.agg(F.sum("n")).first()[0] or 0
    hot = files.where(F.col("n") > max(1000, total / 256)).select("file_no", F.lit(True).alias("_hot"))
    spread = salted(rows, ["file_no"], hot, F.col("record")).repartition("file_no", "_salt").sortWithinPartitions("file_no", "_salt")

    def run(batches):
        common: dict[str, _Sketch] = {}
        now, fields = None, {}

        def done() -> list[tuple]:
            if now is None:
                return []
            for path, field in fields.items():
                sketch = common.setdefault(path, _Sketch(COMMON))
                for text in field.sketch.held:
                    sketch.add(text if _number(text) is None else f"{text}\0{now}")
            return [(now, _sorted_fields(fields))]

        def batch_of(rows):
            return pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], _FIELDS)], names=["file_no", "fields"])

        for batch in batches:
            out = []
            for file_no, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if file_no != now:
                    out += done()
                    now, fields = file_no, {}
                try:
                    record = strict_json.loads(text) if text is not None else None
                except ValueError:
                    record = None
                for path, place, value in fields_of(record, nested) if isinstance(record, dict) else ():
                    field = fields.get(path)
                    if field is None:
                        field = fields[path] = _Field()
                    field.kinds |= bits_of(value)
                    field.n += 1
                    field.place += place
                    if path in nested:
                        continue
                    if type(value) is float or type(value) is int:  # most values, by the shortest way
                        field.sketch.add(repr(value))
                        continue
                    for leaf in leaves(value):
                        field.sketch.add(leaf)
            if out:
                yield batch_of(out)
        yield batch_of([*done(), (None, [{"path": p, "kinds": 0, "n": 0, "place": 0, "sample": x.texts()} for p, x in common.items()])])

    parts = cut(spread.select("file_no", "record").mapInArrow(run, f"file_no long, fields {FIELDS}"))
    keyed = parts.join(F.broadcast(hot), "file_no", "left")
    whole = keyed.where("file_no IS NOT NULL AND _hot IS NULL").select("file_no", "fields")
    split = keyed.where("_hot").groupBy("file_no").agg(F.collect_list("fields").alias("lists")).mapInArrow(_merged, f"file_no long, fields {FIELDS}")
    # One sketch for each task and field: merged in two steps, so that no task holds those of all tasks.
    each = parts.where("file_no IS NULL").withColumn("_part", F.pmod(F.monotonically_increasing_id(), F.lit(64)))
    wide = partial(_merged, size=COMMON)
    some = each.groupBy("_part").agg(F.collect_list("fields").alias("lists")).mapInArrow(wide, f"file_no long, fields {FIELDS}")
    one = some.groupBy(F.lit(0).cast("long")).agg(F.collect_list("fields").alias("lists")).mapInArrow(wide, f"file_no long, fields {FIELDS}")
    texts = F.transform("f.sample", lambda t: F.when(F.split_part(t, F.lit("\0"), F.lit(1)).rlike(NUMBER), F.split_part(t, F.lit("\0"), F.lit(1))).otherwise(t))
    return whole.unionByName(split), one.select(F.explode("fields").alias("f")).select("f.path", texts.alias("common"))


NUMBER = r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$"


def _words(name: str) -> list[str]:
    return [w.lower() for w in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[^\W\d_A-Z]+|\d+", name)]


def name_similarity(a: str, b: str) -> float:
    """0 to 1, from equal, abbreviated or similar words in any order, or from similar letters."""

    def near(x: str, y: str) -> float:
        short, long = sorted((x, y), key=len)
        rest = iter(long)
        short_form = len(short) > 1 and short[0] == long[0] and all(c in rest for c in short)
        return 1.0 if x == y else 0.9 if short_form else SequenceMatcher(None, x, y).ratio() ** 2

    x, y = _words(a), _words(b)
    if not x or not y:
        return float(a == b)
    best = sum(max(near(w, v) for v in y) for w in x) + sum(max(near(w, v) for v in x) for w in y)
    return max(best / (len(x) + len(y)), SequenceMatcher(None, "".join(x), "".join(y)).ratio() ** 2)


def _number(text: str) -> float | None:
    try:
        return float(text) if re.fullmatch(NUMBER[1:-1], text) else None
    except ValueError:
        return None


def value_similarity(a: list[str], b: list[str]) -> float:
    """0 to 1, from two samples of distinct values: shared texts and forms, or distributions of numbers."""
    if not a or not b:
        return 0.0
    x, y = ([v for t in s if (v := _number(t)) is not None] for s in (a, b))
    share = (len(x) / len(a), len(y) / len(b))
    if min(share) > 0.8:
        x, y = np.sort(x), np.sort(y)
        at = np.concatenate([x, y])
        gap = float(np.max(np.abs(np.searchsorted(x, at, "right") / len(x) - np.searchsorted(y, at, "right") / len(y))))
        chance = max(APART, 1.36 * np.sqrt((len(x) + len(y)) / (len(x) * len(y))))
        fit = 1 - 0.3 * gap / chance if gap <= chance else max(0.0, 0.7 - 3 * (gap - chance))
        places = [max((len(t.partition(".")[2].rstrip("0")) for t in s), default=0) for s in (a, b)]
        return fit * max(0.3, 1 - 0.3 * abs(places[0] - places[1]))
    if max(share) > 0.8:
        return 0.0
    if {*a, *b} <= {"true", "false"}:
        return 0.9
    small = min(len(set(a)), len(set(b)))
    shared = len(set(a) & set(b)) / small
    forms = [{re.sub(r"[^\W\d_]+", "a", re.sub(r"\d+", "9", t.partition("\0")[0])) for t in s} for s in (a, b)]
    regular = [{f for f in s if "9" in f and len(f) > 2} for s in forms]
    alike = len(regular[0] & regular[1]) / min(map(len, regular)) if all(regular) else 0.0
    return max(shared, 0.85 * alike)


def similarity(old: dict, new: dict) -> float:
    """0 to 1, of a lost and a new field, from values in the file and over all files, names, positions and fill rates."""
    level, part = old["path"].rpartition(".")[::2]
    if new["path"].rpartition(".")[0] != level:
        return 0.0
    here = value_similarity(old["sample"], new["sample"])
    everywhere = value_similarity(old["common"], new["common"])
    value, name = (here + everywhere) / 2, name_similarity(part, new["path"].rpartition(".")[2])
    place = max(0.0, 1 - abs(old["place"] / old["n"] - new["place"] / new["n"]) / 4)
    fill = min(old["fill"], new["fill"]) / max(old["fill"], new["fill"])
    score = 0.6 * value + 0.25 * name + 0.1 * place + 0.05 * fill
    return max(score, 0.6 + 0.1 * value) if name >= 0.9 else score


def match(old: list[dict], new: list[dict], least: float = SIMILAR) -> list[tuple[str, str]]:
    """(old path, new path) of renames: the assignment of greatest total similarity, each pair reaching `least`."""
    score = np.array([[similarity(a, b) for b in new] for a in old])
    score[score < least] = 0
    return [(old[i]["path"], new[j]["path"]) for i, j in assign(-score) if score[i, j] > 0]


def before(files: DataFrame) -> DataFrame:
    """`file_no, before`: the file just before each in its stream, by exported_at, then file_no; a stream's first has none.

    In two levels, within a stream's months and over them, so that no task orders all files of a stream. A null stream is a stream.
    """
    rows = files.select("file_no", "stream", "exported_at", F.date_trunc("month", F.col("exported_at")).alias("month"))
    within = Window.partitionBy("stream", "month").orderBy("exported_at", "file_no")
    last = rows.groupBy("stream", "month").agg(F.max_by("file_no", F.struct("exported_at", "file_no")).alias("last"))
    over = last.select(F.col("stream").alias("_s"), F.col("month").alias("_m"), F.lag("last").over(Window.partitionBy("stream").orderBy("month")).alias("_before"))
    inner = rows.withColumn("_in", F.lag("file_no").over(within))
    both = inner.join(over, F.col("stream").eqNullSafe(F.col("_s")) & F.col("month").eqNullSafe(F.col("_m")))
    return both.select("file_no", F.coalesce("_in", "_before").alias("before"))


def _few(df: DataFrame) -> DataFrame:
    """A written table, broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= FEW else df


def changes(records: DataFrame, nested: tuple[str, ...] = ("label",)) -> DataFrame:
    """Changes of each file against the one before it in its stream: `file_no, field_path, change_kind, old_path`.

    `records` has file_no, stream, exported_at and record. Files follow each other by exported_at, then file_no; rows
    delivered twice change nothing. Files are held against each other by their fields' paths and kinds; samples of values
    are fetched only for the lost and new fields of a file with both. A stream's first file has no changes; so have
    tables without rows. Rows without file_no are left out, and a null stream is a stream.
    """
    files = cut(files_of(records))
    profiles, common = profile(records, files, nested)
    return _compared(files, profiles, common)


def _compared(files: DataFrame, profiles: DataFrame, common: DataFrame) -> DataFrame:
    shown = ("path", "kinds", "n", "place")
    light = profiles.select("file_no", F.arrays_zip(*(F.col(f"fields.{c}").alias(c) for c in shown)).alias("fields"))
    order = before(files).where("before IS NOT NULL")
    # A file without any field has no profile.
    now = order.join(light.withColumnRenamed("fields", "now"), "file_no", "left")
    both = now.join(light.select(F.col("file_no").alias("before"), F.col("fields").alias("was")), "before", "left")
    none = F.array().cast("array<struct<path:string,kinds:int,n:bigint,place:bigint>>")
    both = both.select("file_no", "before", F.coalesce("now", none).alias("now"), F.coalesce("was", none).alias("was"))
    kinds = F.map_from_arrays(F.col("was.path"), F.transform("was", lambda f: f["kinds"].bitwiseAND(31)))
    both = both.select(
        "file_no", "before", "now", "was", F.array_except("was.path", "now.path").alias("lost"), F.array_except("now.path", "was.path").alias("new"), kinds.alias("kinds"),
    ).withColumn("retyped", F.filter("now", lambda f: F.try_element_at("kinds", f["path"]) != f["kinds"].bitwiseAND(31)))
    both = cut(both.drop("kinds").withColumn("retyped", F.col("retyped.path")).where("size(lost) + size(new) + size(retyped) > 0"))
    level = lambda p: F.when(p.contains("."), F.substring_index(p, ".", 1)).otherwise("")

    def wanted(owner: str, side: str, paths: str, lost: bool) -> DataFrame:
        """The fields of one side, with the part of their level's records that holds them."""
        most = lambda f: F.array_max(F.transform(F.filter(side, lambda x: level(x["path"]) == level(f["path"])), lambda x: x["n"]))
        some = F.transform(F.filter(side, lambda f: F.array_contains(paths, f["path"])), lambda f: F.struct(*(f[c].alias(c) for c in shown), (f["n"] / most(f)).alias("fill")))
        rows = both.where("size(lost) > 0 AND size(new) > 0").select("file_no", F.col(owner).alias("owner"), F.explode(some).alias("f"))
        return rows.select("file_no", "owner", "f.*", F.lit(lost).alias("lost"))

    want = cut(wanted("before", "was", "lost", True).unionByName(wanted("file_no", "now", "new", False)))
    samples = profiles.select(F.col("file_no").alias("owner"), F.explode(F.arrays_zip(F.col("fields.path").alias("path"), F.col("fields.sample").alias("sample"))).alias("s")).select("owner", "s.path", "s.sample")
    sides = samples.join(_few(want), ["owner", "path"]).join(F.broadcast(common), "path", "left")  # one row for each name of a field
    sides = sides.groupBy("file_no").agg(F.collect_list(F.struct(*shown, "fill", "lost", "sample", "common")).alias("fields"))
    renames = cut(sides.mapInArrow(_renames, "file_no long, field_path string, old_path string, retyped boolean"))
    taken = renames.groupBy("file_no").agg(F.flatten(F.collect_list(F.array("field_path", "old_path"))).alias("taken"))
    left = both.join(taken, "file_no", "left").withColumn("taken", F.coalesce("taken", F.array().cast("array<string>")))
    of = lambda column, kind: left.select("file_no", F.explode(F.array_except(column, "taken")).alias("field_path"), F.lit(kind).alias("change_kind"), F.lit("").alias("old_path"))
    renamed = renames.select("file_no", "field_path", F.lit("renamed").alias("change_kind"), "old_path")
    also = renames.where("retyped").select("file_no", "field_path", F.lit("retyped").alias("change_kind"), F.lit("").alias("old_path"))
    return of("new", "added").unionByName(of("lost", "removed")).unionByName(of("retyped", "retyped")).unionByName(renamed).unionByName(also)


def _renames(batches):
    for batch in batches:
        out = []
        for file_no, fields in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            fields = sorted(({**f, "common": f["common"] or []} for f in fields), key=lambda f: f["path"])
            kinds = {(f["path"], f["lost"]): f["kinds"] & 31 for f in fields}
            for old, new in match([f for f in fields if f["lost"]], [f for f in fields if not f["lost"]]):
                out.append((file_no, new, old, kinds[old, True] != kinds[new, False]))
        types = (pa.int64(), pa.string(), pa.string(), pa.bool_())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 4, types, strict=True)], names=["file_no", "field_path", "old_path", "retyped"])


def canonical_names(renames: DataFrame, files: DataFrame, profiles: DataFrame) -> DataFrame:
    """`stream, names`: for each stream with renames, a map from the names that its renames connect to one of them, the one
    that most files of all streams have. Streams stay apart, so that a rename in one joins no fields of another."""
    pairs = renames.where("change_kind = 'renamed'").join(files.select("file_no", "stream"), "file_no").select("stream", "old_path", "field_path").distinct()
    held = profiles.select(F.explode("fields.path").alias("path")).groupBy("path").agg(F.count("*").alias("n"))
    # A stream's pairs of names are as many as its fields at most, squared, however many files it has.
    lists = pairs.join(F.broadcast(held.withColumnsRenamed({"path": "old_path", "n": "n_old"})), "old_path", "left").join(F.broadcast(held.withColumnsRenamed({"path": "field_path", "n": "n_new"})), "field_path", "left")
    lists = lists.groupBy("stream").agg(F.collect_list(F.struct("old_path", "field_path", "n_old", "n_new")).alias("pairs"))

    def run(batches):
        for batch in batches:
            out = [list(_roots(x).items()) for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.map_(pa.string(), pa.string()))], names=["stream", "names"])

    return lists.mapInArrow(run, "stream string, names map<string,string>")


def _roots(pairs: list[dict]) -> dict[str, str]:
    weight = {p[k]: p[n] or 0 for p in pairs for k, n in (("old_path", "n_old"), ("field_path", "n_new"))}
    root = {x: x for x in weight}

    def find(x: str) -> str:
        while root[x] != x:
            x = root[x]
        return x

    for p in pairs:
        root[find(p["field_path"])] = find(p["old_path"])
    groups: dict[str, list[str]] = {}
    for x in sorted(root):
        groups.setdefault(find(x), []).append(x)
    return {x: min(g, key=lambda v: (-weight[v], v)) for g in groups.values() for x in g}


def spark_type(kinds: int) -> str:
    """The one type that holds all values of a field: numbers also where some are written as texts, lists also where some
    are single values, JSON texts for objects."""
    of = "boolean" if kinds & 31 == 4 else "string" if kinds & (TEXT | DEEP | 16) else "double"
    return f"array<{of}>" if kinds & 8 else of


def _as_type(value, kind: str):
    """A JSON value in a type of `spark_type`."""
    if value is None:
        return None
    if kind[:6] == "array<":
        return [_as_type(v, kind[6:-1]) for v in (value if isinstance(value, list) else [value])]
    if kind == "double":
        return float(value)
    return value if kind == "boolean" or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def unified(records: DataFrame, nested: tuple[str, ...] = ("label",), most: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """All records in one table with a typed column for each field, and the changes that led to it.

    Columns are `file_no, record_no`, a column for each canonical name in order of names, in which `.` is `__`, and
    `other`, a map with the JSON texts of fields whose canonical name the record holds twice. The fields of nested
    entries are lists in entry order, null where an entry lacks the field. Records that can't be read are null but for their numbers. The
    vocabulary of fields is collected; more than `most` names raise an error.
    """
    files = cut(files_of(records))
    profiles, common = profile(records, files, nested)
    profiles = cut(profiles)
    report = cut(_compared(files, profiles, common))
    names = cut(canonical_names(report, files, profiles))
    named = profiles.join(files.select("file_no", "stream"), "file_no").select("stream", F.explode("fields").alias("f")).groupBy("stream", "f.path").agg(F.bit_or("f.kinds").alias("kinds"))
    named = _by_stream(named, names).select(F.coalesce(F.try_element_at("names", "path"), "path").alias("path"), "kinds").where(~F.col("path").isin(list(nested)))
    rows = named.groupBy("path").agg(F.bit_or("kinds").alias("kinds")).orderBy("path").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} fields")
    kinds = {r.path: f"array<{spark_type(r.kinds)}>" if r.path.partition(".")[0] in nested and "." in r.path else spark_type(r.kinds) for r in rows}
    columns = {p: p.replace(".", "__") for p in kinds}
    schema = ", ".join(["file_no long", "record_no long", *(f"`{columns[p]}` {t}" for p, t in kinds.items()), "`other` map<string,string>"])
    arrow = [_arrow(t) for t in kinds.values()]

    def run(batches):
        for batch in batches:
            made: list[list] = [[] for _ in kinds]
            other = []
            for text, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                try:
                    record = strict_json.loads(text) if text is not None else None
                except ValueError:
                    record = None
                row, rest = _one_form(record, dict(own or ()), nested) if isinstance(record, dict) else ({}, None)
                for k, (path, kind) in enumerate(kinds.items()):
                    made[k].append(_as_type(row.get(path), kind))
                other.append(rest)
            columns_ = [batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(made, arrow, strict=True)), pa.array(other, pa.map_(pa.string(), pa.string()))]
            yield pa.record_batch(columns_, names=["file_no", "record_no", *columns.values(), "other"])

    rows = records.where(F.col("file_no").isNotNull()).select(F.col("file_no").cast("long"), F.col("record_no").cast("long"), F.col("record").cast("string"), "stream")
    return _by_stream(rows, names).select("file_no", "record_no", "record", "names").mapInArrow(run, schema), report


def _by_stream(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Rows of streams with the streams' names: of few streams by broadcast, else with hot streams salted. A null stream has its names, too."""
    key = F.coalesce(F.concat(F.lit("s"), "stream"), F.lit("")).alias("_key")
    keyed, one = rows.select("*", key), names.select(key, "names")
    if names.count() <= FEW // 16:
        return keyed.join(F.broadcast(one), "_key", "left").drop("_key")
    hot = hot_keys(keyed, ["_key"])
    return salted(keyed, ["_key"], hot, F.monotonically_increasing_id()).join(replicated(one, ["_key"], hot), ["_key", "_salt"], "left").drop("_key", "_salt")


def _one_form(record: dict, names: dict[str, str], nested: tuple[str, ...]) -> tuple[dict, list]:
    """A record's values by canonical path, and the JSON texts of those whose path is taken."""
    row: dict[str, object] = {}
    rest = []

    def put(path: str, value) -> None:
        to = names.get(path, path)
        if to in row:
            rest.append((path, json.dumps(value, ensure_ascii=False)))
        else:
            row[to] = value

    for name, value in record.items():
        if name in nested and value is not None:
            entries = [e if isinstance(e, dict) else {} for e in (value if isinstance(value, list) else [value])]
            for part in dict.fromkeys(k for e in entries for k in e):
                put(f"{name}.{part}", [e.get(part) for e in entries])
        elif value is not None:
            put(name, value)
    return row, rest


def _arrow(kind: str) -> pa.DataType:
    return pa.list_(_arrow(kind[6:-1])) if kind[:6] == "array<" else {"double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}[kind]
