"""Schemas that drift between files.

Every line is loaded as a map from dotted paths to raw values with their types. Path and type statistics are aggregated by
file; each file is compared with the one before it in its lane. A path that is gone and a path that is new are one
renamed field if their contents agree: the shapes of their values, over all files, and the words of their names.
Typed columns are then projected through the chains of renames, and values that don't fit their column are counted.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Shapes are hashed into so many buckets, which bounds the profile of a path.
SHAPE_BUCKETS = 512
#: Least score of a rename, and least agreement of contents within it.
LEAST_SCORE = 0.5
LEAST_CONTENT = 0.3

_ENTRY = "array<struct<path:string,type:string,raw:string>>"


def _no_constant(name: str) -> None:
    raise ValueError(name)


def parse_line(payload: str | None) -> list[tuple[str, str, str]] | None:
    """[(path, type, raw)] of a JSON object, members of objects included and arrays not entered; None for a broken line.

    Types are string, number, boolean, object, array and null. Broken is what isn't one JSON object: other values, cut
    or empty lines, NaN and infinities, nesting beyond what the parser takes. Of a repeated key the last value counts.
    """
    if payload is None:
        return None
    try:
        top = json.loads(payload, parse_constant=_no_constant)
    except (ValueError, RecursionError):
        return None
    if not isinstance(top, dict):
        return None
    out: dict[str, tuple[str, str]] = {}  # a path once, though a key with a point may name another's member
    stack = [("", top)]
    while stack:
        prefix, node = stack.pop()
        for k, v in node.items():
            path = prefix + k
            if isinstance(v, dict):
                out[path] = ("object", "")
                stack.append((path + ".", v))
            elif isinstance(v, list):
                out[path] = ("array", json.dumps(v, ensure_ascii=False, separators=(",", ":")))
            elif isinstance(v, bool):
                out[path] = ("boolean", "true" if v else "false")
            elif isinstance(v, (int, float)):
                out[path] = ("number", repr(v))
            elif v is None:
                out[path] = ("null", "")
            else:
                out[path] = ("string", v)
    return [(p, *x) for p, x in out.items()]


def _text(values: list[str]) -> pa.Array:
    try:
        return pa.array(values, pa.string())
    except UnicodeEncodeError:  # lone surrogates, which JSON can write, have no UTF-8
        return pa.array([v.encode("utf-8", "replace").decode() for v in values], pa.string())


def _parse_batch(payloads: pa.Array) -> pa.Array:
    """Lists of (path, type, raw) for a batch of lines, null for broken ones."""
    offsets: list[int | None] = []
    paths, types, raws = [], [], []
    for x in payloads.to_pylist():
        fields = parse_line(x)
        offsets.append(None if fields is None else len(paths))
        for path, kind, raw in fields or ():
            paths.append(path)
            types.append(kind)
            raws.append(raw)
    offsets.append(len(paths))
    cells = pa.StructArray.from_arrays([_text(paths), pa.array(types, pa.string()), _text(raws)], names=["path", "type", "raw"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), cells)


def load_lines(df: DataFrame, payload: str = "payload") -> DataFrame:
    """``df`` plus ``fields``: an array of (path, type, raw), each path once, null for broken lines."""

    @F.arrow_udf(_ENTRY)
    def parse(a: pa.Array) -> pa.Array:
        return _parse_batch(a)

    return df.withColumn("fields", parse(F.col(payload)))


def shape(kind: str, raw: F.Column, day: F.Column, lane: F.Column) -> F.Column:
    """The shape of a value: what stays the same when a field keeps its meaning from file to file.

    The file's day and lane become marks, long hexadecimal runs their length, runs of digits a 9 (words stay);
    short numbers stay, others become sign, number of digits and whether there is a fraction. The whole value counts; an
    array has the distinct shapes of all of its strings and numbers.
    """
    compact_day = F.replace(day, F.lit("-"), F.lit(""))
    text = F.replace(F.replace(F.replace(raw, lane, F.lit("{lane}")), day, F.lit("{day}")), compact_day, F.lit("{day8}"))
    hexes = F.regexp_replace(text, r"\b[0-9a-f]{24,}\b", F.concat(F.lit("{hex"), F.length(text).cast("string"), F.lit("}")))
    words = F.regexp_replace(hexes, r"\d+", "9")
    number = F.when(raw.rlike(r"^-?\d{1,2}$"), raw).otherwise(F.concat(F.regexp_replace(F.regexp_replace(raw, r"\d*\.\d+(e.*)?$", ".f"), r"\d+", "d"), F.length(F.regexp_extract(raw, r"^-?(\d+)", 1)).cast("string")))
    items = F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(words, F.lit(r'("[^"]*"|9)'), F.lit(1)))), ",")
    return F.when(F.col(kind) == "number", number).when(F.col(kind) == "array", items).otherwise(words)


def field_statistics(df: DataFrame, *, lane: str = "lane", file: str = "receipt_file", day: str = "file_date", payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(by_file, profiles).

    by_file: (lane, file, day, path, type, n_lines) for the types of each path, type null where a path has only nulls.
    profiles: (path, type, shapes), the share of each hashed shape among all values of the table.
    """
    keep = load_lines(df.select(F.col(lane).alias("lane"), F.col(file).alias("file"), F.col(day).alias("day"), F.col(payload).alias("payload")).where("lane is not null and file is not null and day is not null")).where("fields is not null")
    cells = keep.select("lane", "file", "day", F.explode("fields").alias("f")).select("lane", "file", "day", "f.path", "f.type", "f.raw")
    counted = cells.groupBy("lane", "file", "day", "path", "type", F.pmod(F.xxhash64(shape("type", F.col("raw"), F.col("day"), F.col("lane"))), F.lit(SHAPE_BUCKETS)).cast("int").alias("shape")).agg(F.count(F.lit(1)).alias("n")).persist()
    by_file = counted.groupBy("lane", "file", "day", "path", "type").agg(F.sum("n").alias("n_lines"))
    per_shape = counted.where("type not in ('null', 'object')").groupBy("path", "type", "shape").agg(F.sum("n").alias("n"))
    total = per_shape.groupBy("path", "type").agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("shape", "n"))).alias("m"))
    profiles = total.select("path", "type", F.transform_values("m", lambda _, v: v / F.col("n")).alias("shapes"))
    return by_file, profiles


def name_words(path: str) -> list[str]:
    """The words of the last part of a path: split at capitals, digits and separators, lower case."""
    leaf = path.rsplit(".", 1)[-1]
    return [w.lower() for w in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", leaf)] or [leaf.lower()]


def name_agreement(a: str, b: str) -> float:
    """0..1: the share of common words of the two leaf names, a word that begins another counting half."""
    x, y = name_words(a), name_words(b)
    if x == y or "".join(x) == "".join(y):
        return 1.0
    both = len(set(x) & set(y))
    half = sum(1 for p in set(x) - set(y) for q in set(y) - set(x) if len(min(p, q, key=len)) >= 3 and (p.startswith(q) or q.startswith(p)))
    return min(1.0, (both + 0.5 * half) / min(len(set(x)), len(set(y)))) * 0.9


def match_renames(gone: list[tuple[str, str]], new: list[tuple[str, str]], content: dict[tuple[str, str], float]) -> dict[str, str]:
    """{new path: old path} for gone and new (path, type); content: agreement 0..1 by (old, new).

    Pairs of one type are taken by falling score, contents first and names second; two booleans need a common word, as
    their contents say little. An object is renamed if all of its gone members went to one new object.
    """
    scored = []
    for old, kind in gone:
        for now, kind2 in new:
            if kind != kind2 or kind in ("object", None):
                continue
            c, n = content.get((old, now), 0.0), name_agreement(old, now)
            if kind == "boolean":
                c, ok = min(c, 0.5), n >= 0.4
            else:
                ok = c >= LEAST_CONTENT
            score = 0.6 * c + 0.4 * n
            if ok and score >= (0.42 if n > 0 else LEAST_SCORE):
                scored.append((-score, old, now))
    taken: dict[str, str] = {}
    for _, old, now in sorted(scored):
        if now not in taken and old not in taken.values():
            taken[now] = old
    objects = {p for p, t in new if t == "object"}
    for old in sorted((p for p, t in gone if t == "object"), key=lambda p: -p.count(".")):
        members = [p for p, _ in gone if p.startswith(old + ".") and "." not in p[len(old) + 1 :]]
        to = {now.rpartition(".")[0] for now, was in taken.items() if was in members}
        moved = sum(1 for was in taken.values() if was in members)
        if members and moved * 2 > len(members) and len(to) == 1 and (target := to.pop()) in objects and target not in taken:
            kept = [p for p, _ in new if p.startswith(target + ".") and "." not in p[len(target) + 1 :] and p not in taken]
            if len(kept) <= moved:
                taken[target] = old
    return taken


_CHANGES = "lane string, file string, day string, change string, field string, old_field string, type string, old_type string"


_SIDES = ["lane", "file", "day", "side", "path", "type", "other", "old_type", "content"]


def _file_changes(rows: list[tuple]) -> list[tuple]:
    """The changes of one file from its rows (side, path, type, other, old_type, content)."""
    gone, new, content, out = [], [], {}, []
    for side, path, kind, other, was, score in rows:
        if side == "gone":
            gone.append((path, kind))
        elif side == "new":
            new.append((path, kind))
        elif side == "pair":
            content[path, other] = score
        else:
            out.append(("retyped", path, "", kind, was))
    renamed = match_renames(gone, new, content)
    olds = set(renamed.values())
    kinds = dict(gone)
    out += [("renamed", p, renamed[p], t, kinds[renamed[p]]) if p in renamed else ("added", p, "", t, None) for p, t in new]
    return out + [("removed", p, "", None, t) for p, t in gone if p not in olds]


def _changes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Changes of all files of a partition, whose rows come file by file; one file is held at a time."""
    names = [c.split()[0] for c in _CHANGES.split(", ")]
    at, rows = None, []
    for pdf in batches:
        out = []
        cells = pdf[_SIDES].astype(object).where(pdf[_SIDES].notna(), None)
        for lane, file, day, *cell in cells.itertuples(index=False, name=None):
            if at != (lane, file, day):
                out += [(*at, *c) for c in _file_changes(rows)] if rows else []
                at, rows = (lane, file, day), []
            rows.append(tuple(cell))
        yield pd.DataFrame(out, columns=names)
    if rows:
        yield pd.DataFrame([(*at, *c) for c in _file_changes(rows)], columns=names)


def schema_changes(df: DataFrame, *, lane: str = "lane", file: str = "receipt_file", day: str = "file_date", payload: str = "payload") -> DataFrame:
    """(lane, file, day, change, field, old_field, type, old_type): every change of a file against the one before it in its lane.

    change is ``added``, ``removed``, ``renamed`` (old_field is the old path, else '') or ``retyped``. Files follow one
    another by day, then name. Broken lines are left out, and so are files without a line that isn't broken, and rows
    with a null lane, file or day. Nulls have no type: a path with only nulls in a file is neither retyped nor renamed
    there. Repeated lines change nothing; an empty table gives no rows; extra columns are ignored.
    """
    by_file, profiles = field_statistics(df, lane=lane, file=file, day=day, payload=payload)
    typed = by_file.groupBy("lane", "file", "day", "path").agg(F.array_sort(F.collect_set(F.when(F.col("type") != "null", F.col("type")))).alias("types"))
    typed = typed.withColumn("type", F.when(F.size("types") > 0, F.array_join("types", "+"))).drop("types")
    # files of a lane are numbered; a path is new, gone or retyped by its own neighbours in that order: no join
    lane_, path_ = Window.partitionBy("lane"), Window.partitionBy("lane", "path").orderBy("_i")
    files = by_file.select("lane", "file", "day").distinct()  # the windows over a lane see one row a file
    files = files.withColumn("_i", F.row_number().over(lane_.orderBy("day", "file"))).withColumn("_last", F.max("_i").over(lane_))
    at = typed.join(files, ["lane", "file", "day"]).withColumns({"_prev": F.lag("_i").over(path_), "_was": F.lag("type").over(path_), "_next": F.lead("_i").over(path_)}).persist()
    there = F.coalesce(F.col("_prev") == F.col("_i") - 1, F.lit(False))
    event = lambda when, side, i, old: F.when(when, F.struct(F.lit(side).alias("side"), i.alias("_i"), old.alias("old_type")))
    none = F.lit(None).cast("string")
    events = F.array_compact(F.array(
        event((F.col("_i") > 1) & ~there, "new", F.col("_i"), none),
        event(there & (F.col("type") != F.col("_was")), "retyped", F.col("_i"), F.col("_was")),
        event((F.col("_i") < F.col("_last")) & ~F.coalesce(F.col("_next") == F.col("_i") + 1, F.lit(False)), "gone", F.col("_i") + 1, F.col("type")),
    ))
    diff = at.select("lane", "path", "type", F.explode(events).alias("e")).select("lane", "e._i", "path", "type", "e.old_type", "e.side").persist()
    # contents are compared for the pairs of one file and type only
    old = diff.where("side = 'gone'").select("lane", "_i", F.col("path").alias("path"), "type")
    new = diff.where("side = 'new'").select("lane", "_i", F.col("path").alias("other"), "type")
    pairs = old.join(new, ["lane", "_i", "type"]).where("type <> 'object'")
    known = pairs.select("path", "other", "type").distinct()
    known = known.join(profiles.withColumnRenamed("shapes", "_a"), ["path", "type"]).join(profiles.select(F.col("path").alias("other"), "type", F.col("shapes").alias("_b")), ["other", "type"])
    overlap = F.aggregate(F.map_values(F.map_zip_with("_a", "_b", lambda _, x, y: F.least(F.coalesce(x, F.lit(0.0)), F.coalesce(y, F.lit(0.0))))), F.lit(0.0), lambda s, x: s + x)
    scored = pairs.join(known.select("path", "other", "type", overlap.alias("content")), ["path", "other", "type"])
    rows = diff.select("lane", "_i", "side", "path", "type", F.lit(None).cast("string").alias("other"), "old_type", F.lit(None).cast("double").alias("content")).unionByName(
        scored.select("lane", "_i", F.lit("pair").alias("side"), "path", "type", "other", F.lit(None).cast("string").alias("old_type"), "content")
    )
    by_file = ["lane", "file", "day"]
    return rows.join(files.drop("_last"), ["lane", "_i"]).select(*_SIDES).repartition(*by_file).sortWithinPartitions(*by_file).mapInPandas(_changes, _CHANGES)


#: Columns that are always there, with their types by the name a field had first; all others come from the statistics.
COLUMNS = {"schema_version": "string", "status": "string", "receipt_id": "string", "target_date": "date", "source": "string", "rows_appended": "bigint", "prefix_equal": "boolean", "values_published": "boolean"}
#: More distinct fields than this, renames counted once, are no table.
MAX_COLUMNS = 2_000


def name_fields(pdf: pd.DataFrame) -> list[str | None]:
    """For one lane, the name of each row's path: the one it had first, through all renames; no two paths of a file share one.

    pdf: day, file, path, old_path; old_path where the file renames the path. Members of a renamed object go with it. A
    path whose name is held by another of its file gets a number behind it.
    """
    rows: dict[tuple[str, str], dict[str, list[int]]] = {}
    moves: dict[tuple[str, str], dict[str, str]] = {}
    for i, (day, file, path, old) in enumerate(zip(pdf["day"], pdf["file"], pdf["path"], pdf["old_path"], strict=True)):
        at = (day or "", file or "")
        if isinstance(old, str):
            moves.setdefault(at, {})[path] = old
        else:
            rows.setdefault(at, {}).setdefault(path, []).append(i)
    names: list[str | None] = [None] * len(pdf)
    first: dict[str, str] = {}
    for at in sorted(rows):
        moved = {new: first.get(old, old) for new, old in moves.get(at, {}).items()}
        first = {p: n for p, n in first.items() if p not in moves.get(at, {}).values()} | moved
        taken: set[str] = set()
        for path in sorted(rows[at], key=lambda p: (p not in moved, p not in first, p.count("."), p)):
            parent, _, leaf = path.rpartition(".")
            base = name = first.get(path) or (f"{first.get(parent, parent)}.{leaf}" if parent else path)
            k = 1
            while name in taken:
                k += 1
                name = f"{base}#{k}"
            taken.add(name)
            first[path] = name
            for i in rows[at][path]:
                names[i] = name
    return names


def _named(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.assign(name=name_fields(pdf))
    return pdf[pdf["name"].notna()][["lane", "file", "path", "name", "type", "n", "n_whole", "n_day"]]


def column_kinds(stats: list[tuple[str, str, int, int, int]]) -> dict[str, str]:
    """{name: type}: COLUMNS first, then by name, from (name, type of values, lines, whole numbers, days).

    The most frequent type that isn't null counts: number gives bigint if all of them are whole, else double, string gives
    date if more than half are days, array gives array<string>. A name with nulls only is a string.
    """
    by: dict[str, list[tuple[int, str, int, int]]] = {}
    for name, kind, n, whole, days in stats:
        by.setdefault(name, [])
        if kind != "null":
            by[name].append((-n, kind, whole, days))
    kinds = dict(COLUMNS)
    for name in sorted(by):
        n, kind, whole, days = min(by[name], default=(0, "string", 0, 0))
        derived = {"number": "bigint" if whole == -n else "double", "string": "date" if days * 2 > -n else "string", "array": "array<string>"}.get(kind, kind)
        kinds.setdefault(name, derived)
    return kinds


def column_labels(names: list[str], taken: set[str]) -> dict[str, str]:
    """{name: column}, distinct from each other and from ``taken`` without regard to case: later ones get a number."""
    out, taken = {}, {t.lower() for t in taken}
    for name in names:
        label, k = name, 1
        while label.lower() in taken:
            k += 1
            label = f"{name}#{k}"
        taken.add(label.lower())
        out[name] = label
    return out


def consistent_table(df: DataFrame, changes: DataFrame, *, key: str = "raw_id", lane: str = "lane", file: str = "receipt_file", day: str = "file_date", line: str = "line_no", arrived: str = "arrived_at", payload: str = "payload") -> DataFrame:
    """(key, lane, file, day, line, one column per field ..., failed, failed_values): every receipt once, under one schema.

    Of a line delivered several times the last arrival counts. A column follows the renames of its lane and bears the name
    the field had first (a dotted path for members; with a number behind it where another column differs in case only);
    its type is that of COLUMNS, else of most of its values, see ``column_kinds``. The fields are found by one aggregate
    over all files and are at most MAX_COLUMNS. Where a column of single values meets an object, it takes the member
    ``code``, or major and minor joined by a point, and of an array its only item. Objects have no column of their own,
    their members have.
    ``failed`` lists the columns whose value is there but doesn't fit the type; such cells are null and their raw text is
    in ``failed_values``. Broken lines have null in all columns, ``failed`` = ['(line)'] and the line in ``failed_values``.
    """
    rows = df.select(F.col(key).alias("key"), F.col(lane).alias("lane"), F.col(file).alias("file"), F.col(day).alias("day"), F.col(line).alias("line"), F.col(arrived).alias("arrived"), F.col(payload).alias("payload"))
    once = rows.groupBy("lane", "file", "line", "day").agg(F.max_by(F.struct("key", "payload"), F.struct("arrived", "key")).alias("r")).select("r.key", "lane", "file", "day", "line", "r.payload")
    # the paths of all files, with the renames among them
    raw, digits = F.col("raw"), F.regexp_replace("raw", "-", "")
    whole = F.when(F.col("type") == "number", raw.try_cast("bigint").isNotNull())
    is_day = F.when((F.col("type") == "string") & raw.rlike(r"^(\d{4}-\d\d-\d\d|\d{8})$"), F.try_to_timestamp(digits, F.lit("yyyyMMdd")).isNotNull())
    cells = load_lines(rows).select("lane", "file", "day", F.explode("fields").alias("f")).select("lane", "file", "day", "f.path", "f.type", "f.raw")
    counted = cells.groupBy("lane", "file", "day", "path", "type").agg(F.count(F.lit(1)).alias("n"), F.count_if(whole).alias("n_whole"), F.count_if(is_day).alias("n_day")).withColumn("old_path", F.lit(None).cast("string"))
    renamed = changes.where("change = 'renamed'").select("lane", "file", "day", F.col("field").alias("path"), F.col("old_field").alias("old_path"))
    named = counted.unionByName(renamed, allowMissingColumns=True).groupBy("lane").applyInPandas(_named, "lane string, file string, path string, name string, type string, n bigint, n_whole bigint, n_day bigint").persist()
    most = named.groupBy("name", "type").agg(F.sum("n"), F.sum("n_whole"), F.sum("n_day")).limit(6 * MAX_COLUMNS + 1).collect()
    kinds = column_kinds([tuple(x) for x in most])
    if len(kinds) > MAX_COLUMNS or len(most) > 6 * MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} fields")
    labels = column_labels(list(kinds), {key, "lane", "file", "day", "line", "failed", "failed_values"})
    types: dict[str, set[str]] = {}
    for x in most:
        types.setdefault(x["name"], set()).add(x["type"])
    # each name once a line: a file's names are distinct, and renames change with the file only
    wide = named.where("path <> name").select("lane", "file", "path", "name").distinct().groupBy("lane", "file").agg(F.map_from_entries(F.collect_list(F.struct("path", "name"))).alias("names"))
    own = lambda f: F.coalesce(F.col("names")[f["path"]], f["path"])
    m = load_lines(once).join(wide, ["lane", "file"], "left").withColumn("m", F.map_from_entries(F.transform("fields", lambda f: F.struct(own(f).alias("path"), f.alias("f")))))
    out, bad = {}, [F.when(F.col("fields").isNull(), F.struct(F.lit("(line)").alias("column"), F.col("payload").alias("raw")))]
    for name, kind in kinds.items():
        at, has = F.col("m")[F.lit(name)], types.get(name, set())
        value = F.when(~at["type"].isin("null", "object", "array"), at["raw"])
        if kind == "object":
            cast = F.when(at["type"] == "object", F.lit(True))
        elif kind.startswith("array"):
            cast = F.when(at["type"] == "array", F.from_json(at["raw"], kind))
        else:
            if "object" in has:
                part = lambda leaf, name=name: F.col("m")[F.lit(f"{name}.{leaf}")]["raw"]
                inner = F.coalesce(part("code"), F.concat_ws(".", part("major"), part("minor")))
                value = F.when(at["type"] == "object", F.when(F.length(inner) > 0, inner)).otherwise(value)
            if "array" in has:
                items = F.from_json(at["raw"], "array<string>")
                value = F.when(at["type"] == "array", F.when(F.size(items) == 1, F.get(items, F.lit(0)))).otherwise(value)
            if kind == "boolean":
                cast = F.when(F.lower(value).isin("yes", "y", "1", "true"), F.lit(True)).when(F.lower(value).isin("no", "n", "0", "false"), F.lit(False))
            elif kind == "date":
                cast = F.coalesce(F.try_to_timestamp(value, F.lit("yyyy-MM-dd")), F.try_to_timestamp(value, F.lit("yyyyMMdd"))).cast("date")
            else:
                cast = value.try_cast(kind)
        if kind != "object":
            out[name] = cast.alias(labels[name])
        if has - {"null", "object" if kind == "object" else ""}:
            bad.append(F.when((at["type"] != "null") & cast.isNull(), F.struct(F.lit(labels[name]).alias("column"), at["raw"].alias("raw"))))
    table = m.select(F.col("key").alias(key), "lane", "file", "day", "line", *out.values(), F.array_compact(F.array(*bad)).alias("failed"))
    return table.withColumns({"failed": F.transform("failed", lambda b: b["column"]), "failed_values": F.map_from_entries("failed")})
