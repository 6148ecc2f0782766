"""Data-quality checks: each takes a DataFrame and returns its violations; no rows means passed.

Key checks count per key before anything is compared, so repeated keys are combined map-side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows.

    A single column ignores nulls; a combination compares them like values.
    """
    kept = df.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    return kept.groupBy(*columns).agg(F.count("*").alias("n_records")).where("n_records > 1")


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, n_records) for each column that has nulls; all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_records")) for c in columns])
    return counts.select(F.inline(entries)).where("n_records > 0")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list with their number of rows; null passes."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(values))
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent row and how many child rows carry them; null passes."""
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records"))
    known = parent.select(F.col(parent_column).alias("_parent"))
    return keys.join(known, F.col(column) == F.col("_parent"), "left_anti")


def equal_rowcount(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row with both counts when they differ."""
    a = left.agg(F.count("*").alias("left_rows"))
    b = right.agg(F.count("*").alias("right_rows"))
    return a.crossJoin(F.broadcast(b)).where("left_rows <> right_rows")


def outside_unit_interval(df: DataFrame, column: str, null_is_bad: bool = False) -> DataFrame:
    value = F.col(column)
    bad = (value < 0) | (value > 1)
    return df.where(bad | value.isNull() if null_is_bad else bad)


def later_than(df: DataFrame, column: str, as_of: Column) -> DataFrame:
    return df.where(F.col(column) > as_of)


def totals_differ(metric: DataFrame, metric_total: Column, fact: DataFrame, fact_total: Column) -> DataFrame:
    """One row when two totals differ after rounding to six digits."""
    m = metric.agg(F.round(F.coalesce(metric_total, F.lit(0.0)), 6).alias("metric_total"))
    f = fact.agg(F.round(F.coalesce(fact_total, F.lit(0.0)), 6).alias("fact_total"))
    return m.crossJoin(F.broadcast(f)).where(~F.col("metric_total").eqNullSafe(F.col("fact_total")))


def quoted(text: str) -> str:
    """An SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Suite:
    """Checks declared per table; ``summary`` counts the violations of all of them.

    A table is read twice at most. Counts that need no shuffle (nulls, accepted values, ranges, rows) and totals are one
    aggregate per table, or were observed while the table was written (``pass_columns``, ``take``). All key checks of all
    tables are one aggregate over tagged keys: rows are combined map-side per key, so a hot key is a row per task.
    """

    def __init__(self) -> None:
        self._tables: dict[str, DataFrame] = {}
        self._passes: dict[str, dict[str, Column]] = {}
        self._taken: dict[str, dict[str, object]] = {}
        self._keys: dict[str, list[tuple[str, list[str]]]] = {}
        self._domains: dict[str, str] = {}
        # (check, table, columns, kind, what the kind needs)
        self._declared: list[tuple[str, str, str, str, object]] = []
        self._violations: list[tuple[str, str, str, DataFrame]] = []

    def _measure(self, table: str, df: DataFrame, name: str, value: Column) -> str:
        self._tables.setdefault(table, df)
        self._passes.setdefault(table, {})[name] = value
        return f"{table}/{name}"

    def _in_pass(self, table: str, df: DataFrame, check: str, columns: str, bad: Column) -> None:
        self._declared.append((check, table, columns, "count", self._measure(table, df, f"{check}:{columns}", F.count_if(bad))))

    def _key(self, table: str, df: DataFrame, columns: list[str]) -> str:
        """Registers the key for the tagged aggregate; its domain is the set of keys it can be compared with."""
        self._tables.setdefault(table, df)
        tag = f"{table}({','.join(columns)})"
        if tag not in self._domains:
            self._domains[tag] = tag
            self._keys.setdefault(table, []).append((tag, columns))
        return tag

    def _domain(self, tag: str) -> str:
        while self._domains[tag] != tag:
            tag = self._domains[tag]
        return tag

    def not_null(self, table: str, df: DataFrame, columns: list[str]) -> Suite:
        for c in columns:
            self._in_pass(table, df, "not_null", c, F.col(c).isNull())
        return self

    def accepted_values(self, table: str, df: DataFrame, column: str, values: list) -> Suite:
        self._in_pass(table, df, "accepted_values", column, ~F.col(column).isin(values))
        return self

    def unit_interval(self, table: str, df: DataFrame, column: str, null_is_bad: bool = False) -> Suite:
        value = F.col(column)
        bad = (value < 0) | (value > 1)
        self._in_pass(table, df, "unit_interval", column, bad | value.isNull() if null_is_bad else bad)
        return self

    def not_later_than(self, table: str, df: DataFrame, column: str, as_of: Column) -> Suite:
        self._in_pass(table, df, "not_in_future", column, F.col(column) > as_of)
        return self

    def unique(self, table: str, df: DataFrame, columns: list[str]) -> Suite:
        check = "unique" if len(columns) == 1 else "unique_combination"
        self._declared.append((check, table, ",".join(columns), "unique", self._key(table, df, columns)))
        return self

    def relationships(
        self, table: str, child: DataFrame, column: str, parent: DataFrame, parent_column: str, parent_table: str | None = None
    ) -> Suite:
        inner = self._key(table, child, [column])
        outer = self._key(parent_table or f"parent of {table}.{column}", parent, [parent_column])
        self._domains[self._domain(inner)] = self._domain(outer)
        self._declared.append(("relationships", table, column, "orphans", (inner, outer)))
        return self

    def equal_rowcount(self, table: str, df: DataFrame, other_table: str, other: DataFrame) -> Suite:
        sides = tuple(self._measure(name, side, "rows", F.count(F.lit(1))) for name, side in ((table, df), (other_table, other)))
        self._declared.append(("equal_rowcount", table, other_table, "equal", sides))
        return self

    def equal_totals(
        self, table: str, column: str, metric: DataFrame, metric_total: Column, fact_table: str, fact: DataFrame, fact_total: Column
    ) -> Suite:
        """Totals compared after rounding to six digits, as in ``totals_differ``."""
        name = f"total:{table}.{column}"
        sides = (self._measure(table, metric, name, metric_total), self._measure(fact_table, fact, name, fact_total))
        self._declared.append(("total_matches_fact", table, column, "totals", sides))
        return self

    def rows(self, check: str, table: str, columns: str, violations: DataFrame) -> Suite:
        """Any query whose rows are violations."""
        self._violations.append((check, table, columns, violations))
        return self

    def pass_columns(self, table: str) -> list[Column]:
        """The aggregates of a table's first pass, for observing them while the table is written."""
        return [value.alias(name) for name, value in self._passes.get(table, {}).items()]

    def take(self, table: str, observed: dict[str, object]) -> Suite:
        """Values of ``pass_columns`` observed on exactly the rows of the table; they spare its first pass."""
        self._taken[table] = observed
        return self

    def _first_passes(self, spark) -> list[DataFrame]:
        """(name, amount): one row per aggregate, from one pass per table or from what was observed."""
        parts, known = [], []
        for table, columns in self._passes.items():
            taken = self._taken.get(table, {})
            known += [(f"{table}/{name}", taken[name]) for name in columns if name in taken]
            left = {name: value for name, value in columns.items() if name not in taken}
            if left:
                counted = self._tables[table].agg(*[value.alias(f"v{i}") for i, value in enumerate(left.values())])
                entries = [F.struct(F.lit(f"{table}/{name}").alias("name"), F.col(f"v{i}").cast("double").alias("amount")) for i, name in enumerate(left)]
                parts.append(counted.select(F.inline(F.array(*entries))))
        if known:
            entries = [f"named_struct('name', {quoted(name)}, 'amount', {'null' if amount is None else f'{float(amount)!r}'!r})" for name, amount in known]
            rows = spark.range(1).select(F.expr(f"inline(array({', '.join(entries)}))"))
            parts.append(rows.select("name", F.col("amount").try_cast("double").alias("amount")))
        return parts

    def _key_pass(self) -> list[DataFrame]:
        """(name, amount): violations of all key checks, from one aggregate over the keys of all tables."""
        places: dict[str, int] = {}
        sizes: dict[str, int] = {}
        for tag in self._domains:
            domain = self._domain(tag)
            places[tag] = sizes.get(domain, 0)
            sizes[domain] = places[tag] + 1
        numbers = {domain: i for i, domain in enumerate(sizes)}
        tagged = []
        for table, keys in self._keys.items():
            entries = []
            for tag, columns in keys:
                parts = [F.col(c).cast("string") for c in columns]
                # parts of a combination carry their length, so different combinations have different texts
                whole = parts[0] if len(parts) == 1 else F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts])
                entry = F.struct(F.lit(numbers[self._domain(tag)]).alias("domain"), whole.alias("key"), F.lit(places[tag]).alias("place"))
                entries.append(F.when(F.col(columns[0]).isNotNull(), entry) if len(columns) == 1 else entry)
            # rows of one key check need no list
            found = self._tables[table].select(entries[0].alias("e")) if len(entries) == 1 else self._tables[table].select(F.explode(F.array(*entries)).alias("e"))
            tagged.append(found.where(F.col("e").isNotNull()).select("e.*"))
        if not tagged:
            return []
        width = max(sizes.values())
        per_key = reduce(DataFrame.unionByName, tagged).groupBy("domain", "key").agg(*[F.count_if(F.col("place") == i).alias(f"n{i}") for i in range(width)])
        bad = {}
        for _, _, _, kind, needs in self._declared:
            if kind == "unique":
                bad[f"unique {needs}"] = (F.col("domain") == numbers[self._domain(needs)]) & (F.col(f"n{places[needs]}") > 1)
            elif kind == "orphans":
                inner, outer = needs
                bad[f"orphans {inner} {outer}"] = (F.col("domain") == numbers[self._domain(inner)]) & (F.col(f"n{places[inner]}") > 0) & (F.col(f"n{places[outer]}") == 0)
        counted = per_key.agg(*[F.count_if(condition).alias(f"v{i}") for i, condition in enumerate(bad.values())])
        entries = [F.struct(F.lit(name).alias("name"), F.col(f"v{i}").cast("double").alias("amount")) for i, name in enumerate(bad)]
        return [counted.select(F.inline(F.array(*entries)))]

    def summary(self) -> DataFrame:
        """(check_name, table_name, columns, n_violations, passed), one row per declared check."""
        spark = next(iter(self._tables.values()), None) or self._violations[0][3]
        parts = [*self._first_passes(spark.sparkSession), *self._key_pass()]
        for i, (_, _, _, violations) in enumerate(self._violations):
            parts.append(violations.agg(F.count("*").cast("double").alias("amount")).select(F.lit(f"rows {i}").alias("name"), "amount"))
        # one row per aggregate; a null total has no entry
        amounts = reduce(DataFrame.unionByName, parts).where(F.col("amount").isNotNull())
        found = amounts.agg(F.map_from_entries(F.collect_list(F.struct("name", "amount"))).alias("found"))

        # SQL text: a hundred checks make thousands of calls otherwise
        def value(name: str) -> str:
            return f"try_element_at(found, {quoted(name)})"

        rows = []
        for check, table, columns, kind, needs in self._declared:
            if kind == "count":
                n = value(needs)
            elif kind == "unique":
                n = value(f"unique {needs}")
            elif kind == "orphans":
                n = value(f"orphans {needs[0]} {needs[1]}")
            elif kind == "equal":
                n = f"if({value(needs[0])} <> {value(needs[1])}, 1, 0)"
            else:
                left, right = (f"round(coalesce({value(side)}, 0.0D), 6)" for side in needs)
                n = f"if({left} <=> {right}, 0, 1)"
            rows.append((check, table, columns, n))
        rows += [(check, table, columns, value(f"rows {i}")) for i, (check, table, columns, _) in enumerate(self._violations)]
        entries = [
            f"named_struct('check_name', {quoted(check)}, 'table_name', {quoted(table)}, 'columns', {quoted(columns)}, 'n_violations', cast({n} as bigint))"
            for check, table, columns, n in rows
        ]
        return found.select(F.expr(f"inline(array({', '.join(entries)}))")).withColumn("passed", F.col("n_violations") == 0)
