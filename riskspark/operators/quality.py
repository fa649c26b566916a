"""Data-quality audits: the constraints of the reference's DDL, checked as jobs.

The reference declares primary keys, foreign keys, NOT NULL and value
ranges, and bulk-loads without checking the foreign keys. Here each rule
is an aggregate or anti-join over the data, so the audit scales with the
tables and reports counts instead of failing row by row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.session import scratch_path

#: Orphan keys of one parent are broadcast up to this number.
FEW_KEYS = 1_000_000


def pk_duplicates(df: DataFrame, key: Sequence[str], table: str) -> DataFrame:
    """Keys that occur more than once: (table_name, key_value, occurrences)."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1)
            .select(F.lit(table).alias("table_name"),
                    F.concat_ws("|", *[F.col(k).cast("string") for k in key]).alias("key_value"),
                    "occurrences"))


def fk_orphans(child: DataFrame, fk: Sequence[str], parent: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Child rows whose non-null foreign key has no parent (nullable FKs are exempt)."""
    parent_keys = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(pk)]).distinct()
    not_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in fk])
    cond = [child[c] == parent_keys[f"_p{i}"] for i, c in enumerate(fk)]
    return child.where(not_null).join(parent_keys, cond, "left_anti")


@dataclass(frozen=True)
class ForeignKey:
    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


def fk_audit(tables: Mapping[str, DataFrame], fks: Sequence[ForeignKey]) -> DataFrame:
    """One row per foreign key: (child_table, fk_columns, parent_table, orphan_rows).

    A child's rows are counted per key first (a partial aggregate, so a hot
    key is one row), and only those counts meet the parent's keys.
    """
    parts = []
    for f in fks:
        present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in f.columns])
        keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(f.columns)]
        counts = tables[f.child].where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        parent = tables[f.parent].select(*[F.col(p).alias(f"_k{i}") for i, p in enumerate(f.parent_columns)])
        orphans = counts.join(parent, [f"_k{i}" for i in range(len(f.columns))], "left_anti")
        parts.append(orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows")).select(
            F.lit(f.child).alias("child_table"), F.lit(",".join(f.columns)).alias("fk_columns"),
            F.lit(f.parent).alias("parent_table"), "orphan_rows"))
    return reduce(DataFrame.unionByName, parts)


def null_audit(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count of every column in one pass: (table_name, column_name, null_rows)."""
    cols = list(columns or df.columns)
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return counts.select(F.lit(table).alias("table_name"),
                         F.expr(f"stack({len(cols)}, {pairs}) AS (column_name, null_rows)"))


@dataclass(frozen=True)
class Rule:
    name: str
    table: str
    ok: Column          # true when the row passes; null values pass (NOT NULL is a separate rule)


def domain_audit(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """Violations per rule, one aggregate pass per table: (rule_name, table_name, violations)."""
    by_table: dict[str, list[Rule]] = {}
    for r in rules:
        by_table.setdefault(r.table, []).append(r)
    parts = []
    for table, rs in by_table.items():
        agg = tables[table].agg(*[F.count(F.when(~F.coalesce(r.ok, F.lit(True)), 1)).alias(f"_r{i}")
                                  for i, r in enumerate(rs)])
        pairs = ", ".join(f"'{r.name}', `_r{i}`" for i, r in enumerate(rs))
        parts.append(agg.select(F.expr(f"stack({len(rs)}, {pairs}) AS (rule_name, violations)"))
                     .select("rule_name", F.lit(table).alias("table_name"), "violations"))
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Mapping[str, DataFrame], with_total: bool = True) -> DataFrame:
    """The load script's verification query: one (table_name, row_count) per table, plus TOTAL."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    counts = reduce(DataFrame.unionByName, parts)
    if not with_total:
        return counts
    # ROLLUP adds the grand total in the same aggregation, so each table is counted once.
    return (counts.rollup("table_name").agg(F.sum("row_count").cast("bigint").alias("row_count"))
            .select(F.coalesce(F.col("table_name"), F.lit("TOTAL")).alias("table_name"), "row_count"))


def reconcile(counts: DataFrame, expected: Mapping[str, int] | DataFrame) -> DataFrame:
    """Compare counts with a manifest (a mapping, or table_name and expected_rows): (table_name, row_count, expected_rows, matches)."""
    if not isinstance(expected, DataFrame):
        expected = counts.sparkSession.createDataFrame([(k, int(v)) for k, v in expected.items()], "table_name string, expected_rows long")
    return (counts.join(expected, "table_name", "full")
            .withColumn("matches", F.coalesce(F.col("row_count") == F.col("expected_rows"), F.lit(False))))


# -- audits that read a source once -----------------------------------------------------------
@dataclass(frozen=True)
class View:
    """A table that is a filter and a projection of a source; ``distinct``: the distinct rows of whole-number columns,
    and what ``derived`` makes of these columns."""

    name: str
    source: str
    columns: Mapping[str, Column]
    where: Column | None = None
    distinct: bool = False
    derived: Callable[[Mapping[str, Column]], Mapping[str, Column]] | None = None

    def all_columns(self, columns: Mapping[str, Column] | None = None) -> Mapping[str, Column]:
        columns = columns or self.columns
        return {**columns, **(self.derived(columns) if self.derived else {})}

    def holds(self) -> Column:
        return F.lit(True) if self.where is None else F.coalesce(self.where, F.lit(False))

    def frame(self, sources: Mapping[str, DataFrame]) -> DataFrame:
        rows = sources[self.source] if self.where is None else sources[self.source].where(self.where)
        rows = rows.select(*[c.alias(n) for n, c in self.columns.items()])
        rows = rows.distinct() if self.distinct else rows
        return rows.withColumns(self.derived({n: F.col(n) for n in self.columns})) if self.derived else rows


def _by_source(views: Sequence[View]) -> dict[str, tuple[list[View], list[View]]]:
    """Per source, its plain and its distinct views."""
    out: dict[str, tuple[list[View], list[View]]] = {}
    for v in views:
        out.setdefault(v.source, ([], []))[v.distinct].append(v)
    return out


def _distinct_rows(source: DataFrame, views: Sequence[View]) -> DataFrame:
    """The rows of all distinct views of a source in one aggregate: (view, k0, k1, ..), ``view`` by place in ``views``."""
    width = max(len(v.columns) for v in views)
    rows = [(F.when(v.holds(), F.lit(i)), [c.cast("bigint") for c in v.columns.values()] + [F.lit(None).cast("bigint")] * (width - len(v.columns)))
            for i, v in enumerate(views)]
    keys = [f"k{j}" for j in range(width)]
    return _unfolded(source, ["view", *keys], [[i, *k] for i, k in rows]).groupBy("view", *keys).agg(F.count(F.lit(1)).alias("n"))


def _unfolded(source: DataFrame, names: Sequence[str], rows: Sequence[Sequence[Column]]) -> DataFrame:
    """Of each row of ``source`` those of ``rows`` whose first column is not null."""
    if len(rows) == 1:
        return source.select(*[c.alias(n) for c, n in zip(rows[0], names)]).where(F.col(names[0]).isNotNull())
    return source.select(F.stack(F.lit(len(rows)), *[c for row in rows for c in row]).alias(*names)).where(F.col(names[0]).isNotNull())


def count_in_views(sources: Mapping[str, DataFrame], views: Sequence[View], wanted: Callable[[View], Mapping[str, Column]]) -> DataFrame:
    """(table_name, what, rows): for each view, the rows that meet each condition of ``wanted``.

    Per source one aggregate over its plain views, and one over the rows of its distinct views.
    """
    parts = []
    for name, (plain, distinct) in _by_source(views).items():
        if counted := [(v.name, what, v.holds() & F.coalesce(cond, F.lit(False))) for v in plain for what, cond in wanted(v).items()]:
            row = sources[name].agg(*[F.count_if(cond).alias(f"_c{i}") for i, (_, _, cond) in enumerate(counted)])
            parts.append(_stacked(row, [(table, what) for table, what, _ in counted]))
        if distinct:
            # rows that meet no condition are not told apart
            asked = [replace(v, where=v.holds() & reduce(lambda a, b: a | b, (F.coalesce(x, F.lit(False)) for x in wanted(replace(v, columns=v.all_columns(), derived=None)).values())))
                     for v in distinct]
            rows = _distinct_rows(sources[name], asked)
            counted = []
            for i, v in enumerate(distinct):
                keyed = View(v.name, v.source, v.all_columns({c: F.col(f"k{j}") for j, c in enumerate(v.columns)}))
                counted += [(v.name, what, (F.col("view") == i) & F.coalesce(cond, F.lit(False))) for what, cond in wanted(keyed).items()]
            row = rows.agg(*[F.count_if(cond).alias(f"_c{i}") for i, (_, _, cond) in enumerate(counted)])
            parts.append(_stacked(row, [(table, what) for table, what, _ in counted]))
    return reduce(DataFrame.unionByName, parts)


def _stacked(row: DataFrame, names: Sequence[tuple[str, str]]) -> DataFrame:
    cells = ", ".join(f"'{table}', '{what}', `_c{i}`" for i, (table, what) in enumerate(names))
    return row.select(F.expr(f"stack({len(names)}, {cells}) AS (table_name, what, rows)"))


def view_row_counts(sources: Mapping[str, DataFrame], views: Sequence[View], with_total: bool = True) -> DataFrame:
    """``row_counts`` of views: (table_name, row_count), each source read once."""
    counts = count_in_views(sources, views, lambda v: {"rows": F.lit(True)}).select("table_name", F.col("rows").alias("row_count"))
    if not with_total:
        return counts
    return (counts.rollup("table_name").agg(F.sum("row_count").cast("bigint").alias("row_count"))
            .select(F.coalesce(F.col("table_name"), F.lit("TOTAL")).alias("table_name"), "row_count"))


def view_null_audit(sources: Mapping[str, DataFrame], views: Sequence[View], required: Mapping[str, Sequence[str]]) -> DataFrame:
    """``null_audit`` of views: (table_name, column_name, null_rows), each source read once."""
    found = count_in_views(sources, views, lambda v: {c: v.columns[c].isNull() for c in required[v.name]})
    return found.select("table_name", F.col("what").alias("column_name"), F.col("rows").alias("null_rows"))


def view_pk_duplicates(sources: Mapping[str, DataFrame], views: Sequence[View], keys: Mapping[str, Sequence[str]], tasks: int | None = None) -> DataFrame:
    """``pk_duplicates`` of views: (table_name, key_value, occurrences).

    Keys hardly repeat, so that counting before the shuffle would hold each of them in memory for nothing: with ``tasks``, rows
    are dealt by key to that many tasks first, and each counts its own keys.

    Views of one source whose keys are the same expressions are counted in one
    grouping. A distinct view whose key is all of its columns has no duplicates
    by construction and is not read.
    """
    groups: dict[tuple, list[View]] = {}
    for v in views:
        if not (v.distinct and set(keys[v.name]) == set(v.columns)):
            same = sources[v.source].select(*[v.columns[k] for k in keys[v.name]]).columns      # an expression's name is its text
            groups.setdefault((v.source, v.distinct, *same), []).append(v)
    parts = []
    for (source, distinct, *_), same in groups.items():
        names = [f"_k{j}" for j in range(len(keys[same[0].name]))]
        base = same[0].frame(sources) if distinct else sources[source]
        cols = [F.col(k) if distinct else same[0].columns[k] for k in keys[same[0].name]]
        counts = [F.count_if(F.lit(True) if distinct else v.holds()).alias(f"_c{i}") for i, v in enumerate(same)]
        if tasks:
            held = [(F.lit(True) if distinct else v.holds()).alias(f"_h{i}") for i, v in enumerate(same)]
            base = base.select(*[c.alias(n) for c, n in zip(cols, names)], *held).repartition(tasks, *names)
            cols, counts = [F.col(n) for n in names], [F.count_if(f"_h{i}").alias(f"_c{i}") for i in range(len(same))]
        counted = base.groupBy(*[c.alias(n) for c, n in zip(cols, names)]).agg(*counts)
        counted = counted.where(F.greatest(*[F.col(f"_c{i}") for i in range(len(same))], F.lit(0)) > 1)
        cells = ", ".join(f"'{v.name}', `_c{i}`" for i, v in enumerate(same))
        value = F.concat_ws("|", *[F.col(n).cast("string") for n in names])
        parts.append(counted.select(value.alias("key_value"), F.expr(f"stack({len(same)}, {cells}) AS (table_name, occurrences)"))
                     .where("occurrences > 1").select("table_name", "key_value", "occurrences"))
    return reduce(DataFrame.unionByName, parts)


def view_fk_audit(sources: Mapping[str, DataFrame], views: Sequence[View], fks: Sequence[ForeignKey]) -> DataFrame:
    """``fk_audit`` of views, for foreign keys of one whole-number column: one grouping by (parent, key), no join.

    Every row gives one entry for each parent and key that it holds, as a parent, by reference, or both; ``mask`` tells as which.
    Entries meet at (parent, key), where references without a parent are orphans. Partial aggregates make one entry of
    a hot key per task. The orphan keys are written once, under the shared checkpoint folder: their references are the
    counts of plain views, and only rows of distinct views that hold such a key are told apart.
    """
    parents = list(dict.fromkeys((f.parent, f.parent_columns[0]) for f in fks))
    is_distinct = {v.name: v.distinct for v in views}
    slots: dict[int, list[ForeignKey]] = {i: [] for i in range(len(parents))}      # bit j + 1 of an entry's mask; bit 0 is the parent
    for f in fks:
        slots[parents.index((f.parent, f.parent_columns[0]))].append(f)
    entries = []
    for name, pair in _by_source(views).items():
        made: dict[tuple[int, str], tuple[Column, list[tuple[int, Column]]]] = {}
        for v in (*pair[0], *pair[1]):
            columns = v.all_columns()
            keys = [(p, 0, columns[column]) for p, (table, column) in enumerate(parents) if table == v.name]
            keys += [(p, j + 1, columns[f.columns[0]]) for p, of in slots.items() for j, f in enumerate(of) if f.child == v.name]
            for p, bit, column in keys:
                key, text = column.cast("bigint"), sources[name].select(column).columns[0]      # an expression's name is its text
                made.setdefault((p, text), (key, []))[1].append((bit, v.holds() & (key.isNotNull() if bit else F.lit(True))))
        if made:
            rows = []
            for (p, _), (key, bits) in made.items():
                mask = reduce(lambda a, b: a + b, [F.when(cond, F.lit(1 << bit)).otherwise(F.lit(0)) for bit, cond in bits])
                rows.append([F.when(mask > 0, F.lit(p)), key, mask])
            entries.append(_unfolded(sources[name], ["p", "k", "mask"], rows))
    width = max(map(len, slots.values()))
    met = reduce(DataFrame.unionByName, entries).groupBy("p", "k").agg(
        F.bool_or(F.col("mask").bitwiseAND(1) > 0).alias("has_parent"),
        *[F.count_if(F.col("mask").bitwiseAND(2 << j) > 0).alias(f"_n{j}") for j in range(width)])
    spark = met.sparkSession
    path = scratch_path(spark, "orphans")
    met.where(~F.col("has_parent")).drop("has_parent").write.parquet(path)
    orphans = spark.read.schema(met.drop("has_parent").schema).parquet(path)
    place = {f: (p, j) for p, of in slots.items() for j, f in enumerate(of)}
    held = {f: (F.col("p") == place[f][0]) & (F.col(f"_n{place[f][1]}") > 0) for f in fks if is_distinct[f.child]}
    found = dict(zip(held, orphans.agg(F.count(F.lit(1)), *[F.count_if(cond) for cond in held.values()]).first()[1:]))      # one row
    row = orphans.agg(F.count(F.lit(1)).alias("_any"), *[F.coalesce(F.sum(F.when(F.col("p") == place[f][0], F.col(f"_n{place[f][1]}"))), F.lit(0)).alias(f"_c{i}")
                                                         for i, f in enumerate(fks) if f not in held])
    cells = [(f, "0L" if f in held else f"_c{i}") for i, f in enumerate(fks) if not found.get(f)]
    stack = ", ".join(f"'{f.child}', '{f.columns[0]}', '{f.parent}', {n}" for f, n in cells)
    names = "(child_table, fk_columns, parent_table, orphan_rows)"
    parts = [row.select(F.expr(f"stack({len(cells)}, {stack}) AS {names}"))] if cells else []
    by_name = {v.name: v for v in views}
    for f in fks:
        if n := found.get(f):
            keys = orphans.where(held[f]).select(F.col("k").alias("_orphan"))
            rows = replace(by_name[f.child], distinct=False).frame(sources)
            rows = rows.join(F.broadcast(keys) if n <= FEW_KEYS else keys, F.col(f.columns[0]).cast("bigint") == F.col("_orphan"), "left_semi")
            parts.append(rows.distinct().agg(F.count(F.lit(1)).alias("orphan_rows")).select(
                F.lit(f.child).alias("child_table"), F.lit(f.columns[0]).alias("fk_columns"), F.lit(f.parent).alias("parent_table"), "orphan_rows"))
    return reduce(DataFrame.unionByName, parts)
