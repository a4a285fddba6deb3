"""Spark SQL over a lake's tables under the names ``bronze.x``, ``silver.x``, ``gold.x``, ``state.x``."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake import schemas as S
from wattlake.operators.ledger import COMMIT, state_sql
from wattlake.plans.jobs import Lake
from wattlake.session import use_utc
from wattlake.sources.tables import table_exists

logger = logging.getLogger(__name__)

LAKE_TABLES = {
    "bronze": {"electricity_mix": S.BRONZE, "electricity_flows": S.BRONZE},
    "silver": {
        "electricity_mix": S.SILVER_MIX, "electricity_flows": S.SILVER_FLOWS,
        "silver_mix_bad_data": S.BAD_DATA, "silver_flows_bad_data": S.BAD_DATA,
    },
    "gold": {
        "daily_electricity_mix": S.GOLD_MIX, "daily_imports": S.GOLD_IMPORTS, "daily_exports": S.GOLD_EXPORTS,
    },
    "state": {"el_state": S.LEDGER_STATE},
}

# Latest rows of every table: (table, number of rows). Fixed values.
INSPECTIONS = {
    "bronze_flows": ("bronze.electricity_flows", 10),
    "bronze_mix": ("bronze.electricity_mix", 10),
    "silver_mix": ("silver.electricity_mix", 6),
    "silver_flows": ("silver.electricity_flows", 10),
    "gold_exports": ("gold.daily_exports", 10),
    "gold_imports": ("gold.daily_imports", 10),
    "gold_mix": ("gold.daily_electricity_mix", 10),
    "state": ("state.el_state", 10),
}


# What a bounded query may be made of: classes of the parsed text, and functions.
QUERY_NODES = frozenset("""Project Filter Aggregate Sort GlobalLimit LocalLimit Offset Distinct SubqueryAlias
    UnresolvedSubqueryColumnAliases UnresolvedWith UnresolvedRelation Join Union Except Intersect UnresolvedHaving
    OneRowRelation WithWindowDefinition""".split())
CLOSED_EXPRESSIONS = frozenset(["ExpressionWithUnresolvedIdentifier"])
SUBQUERIES = frozenset(["ScalarSubquery", "Exists", "ListQuery", "LateralSubquery"])
FUNCTIONS = frozenset("""abs any any_value array array_contains avg bool_and bool_or bround cardinality ceil ceiling
    coalesce concat concat_ws contains corr count count_if cume_dist current_date date date_add
    date_diff date_format date_sub date_trunc datediff day dayofmonth dayofweek dayofyear dense_rank div double endswith every
    exp extract first first_value float floor greatest hour if ifnull initcap int isnan isnotnull isnull lag last last_day
    last_value lcase lead least left length ln log log10 lower lpad ltrim make_date map max max_by mean median min min_by mod
    month months_between named_struct next_day not ntile nullif nvl nvl2 percent_rank percentile percentile_approx power quarter
    rank regr_slope replace right round row_number rpad rtrim sign size some sort_array sqrt startswith std stddev
    stddev_pop stddev_samp string struct substr substring sum timestamp to_date to_timestamp trim trunc try_cast try_divide ucase
    upper var_pop var_samp variance weekofyear when width_bucket year""".split())


class NotAReadOnlyQuery(ValueError):
    """The text is not a plain query over the permitted tables."""


class ForeignTable(ValueError):
    """A name that the lake needs belongs to a table that is not the lake's."""


class SqlSurface:
    """Registers the lake's tables as external tables and runs SQL over them.

    ``prefix`` goes in front of the database names, so that several lakes can be registered side by side. Queries run
    in a session of their own, in which a name in double quotes is a name: ``"gold.daily_imports"`` is a table too.
    """

    def __init__(self, lake: Lake, prefix: str = ""):
        self.lake = lake
        self.prefix = prefix
        self.spark = lake.spark
        use_utc(self.spark)
        self.session = self._new_session()

    def _new_session(self):
        session = self.spark.newSession()
        for key in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold"):
            if (value := self.spark.conf.get(key, None)) is not None:
                session.conf.set(key, value)
        session.conf.set("spark.sql.session.timeZone", "UTC")
        session.conf.set("spark.sql.ansi.enabled", "true")
        session.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
        # bare names are the lake's temporary views or nothing: no table is found in an empty database
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}no_tables")
        session.catalog.setCurrentDatabase(f"{self.prefix}no_tables")
        return session

    def register(self) -> list[str]:
        """(Re-)register every table that exists; others are reported and skipped. A table of the same name that is
        not the lake's is never replaced."""
        found = []
        for layer, names in LAKE_TABLES.items():
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer}")
            for name, schema in names.items():
                if layer == "state":
                    self._register_state(name)
                elif table_exists(self.spark, self.lake.path(layer, name)):
                    self._register_table(layer, name, schema)
                else:
                    self._drop_own(layer, name)
                    logger.warning("no table %s.%s in %s", layer, name, self.lake.root)
                    continue
                found.append(f"{layer}.{name}")
        return found

    def _drop_own(self, layer: str, name: str, path: str | None = None) -> None:
        """Make room for a name: only what lies in the lake is dropped."""
        full = f"{self.prefix}{layer}.{name}"
        if not self.spark.catalog.tableExists(full):
            return
        described = {r.col_name: r.data_type for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {full}").collect()}
        text = described.get("Location") or described.get("View Text") or ""
        if (path or self.lake.path(layer, name)).rstrip("/").removeprefix("file:") not in text:
            raise ForeignTable(f"{full} belongs to another owner: {text}")
        self.spark.sql(f"DROP {'VIEW' if described.get('Type') == 'VIEW' else 'TABLE'} {full}")

    def _register_table(self, layer: str, name: str, schema) -> None:
        partitioned = set(S.DAY_COLUMNS) <= set(schema.fieldNames())
        partition_by = f"PARTITIONED BY ({', '.join(S.DAY_COLUMNS)})" if partitioned else ""
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        self._drop_own(layer, name)
        self.spark.sql(
            f"CREATE TABLE {self.prefix}{layer}.{name} ({columns}) USING parquet {partition_by} "
            f"LOCATION '{self.lake.path(layer, name)}'"
        )
        if partitioned:
            self.spark.catalog.recoverPartitions(f"{self.prefix}{layer}.{name}")
        self._view(f"{layer}.{name}", f"SELECT * FROM {self.prefix}{layer}.{name}")
        if layer == "gold":
            self._view(name, f"SELECT * FROM {self.prefix}{layer}.{name}")

    def _view(self, name: str, query: str) -> None:
        self.session.sql(query).createOrReplaceTempView(f"`{name}`")

    def _register_state(self, name: str) -> None:
        """The ledger's current state under the name of the status table: a view over all its commits."""
        ledger, commits = self.lake.ledger, f"{self.prefix}state.{name}_commits"
        ledger.state().createOrReplaceTempView(name)
        if not table_exists(self.spark, ledger.commits.path):
            return
        full = f"{self.prefix}state.{name}"
        self._drop_own("state", name, commits)
        self._drop_own("state", f"{name}_commits", ledger.commits.path)
        self.spark.sql(f"CREATE TABLE {commits} ({COMMIT}) USING json LOCATION '{ledger.commits.path}'")
        self.spark.sql(f"CREATE VIEW {full} AS {state_sql(commits)}")
        for view in (f"state.{name}", name):
            self._view(view, f"SELECT * FROM {full}")

    def sql(self, query: str, args: Mapping[str, object] | None = None) -> DataFrame:
        """Any query; ``args`` are bound to ``:name`` markers. Gold tables also answer to bare names."""
        return self.session.sql(query, dict(args or {}))

    def latest_rows(self, table: str, rows: int) -> DataFrame:
        return self.sql(f"SELECT * FROM {self.prefix}{table} ORDER BY process_ts DESC LIMIT {int(rows)}")

    def bounded(self, query: str, rows: int = 1000, args: Mapping[str, object] | None = None,
                max_bytes: int = 65_536) -> DataFrame:
        """A read-only query over the gold tables with a bounded result: so many rows, and texts of at most ``max_bytes``;
        a longer one is an error.

        The parsed text decides, not its letters: it may hold nothing but query nodes, the gold tables and names it
        defines itself, and listed functions. So commands, files, other tables and calls into the JVM stay out
        however they are written, and their names in a literal do no harm.
        """
        body = query.strip().rstrip(";")
        check_query(self._parsed(body), self.prefix)
        return _in_bytes(self.sql(body, args).limit(rows), max_bytes)

    def _parsed(self, text: str):
        """The text as a plan, read with the settings of the surface's session."""
        active = self.session._jvm.org.apache.spark.sql.classic.SparkSession
        before = active.getActiveSession()
        active.setActiveSession(self.session._jsparkSession)
        try:
            return self.session._jsparkSession.sessionState().sqlParser().parsePlan(text)
        except Exception as error:
            raise NotAReadOnlyQuery(text) from error
        finally:
            active.setActiveSession(before.get()) if before.isDefined() else active.clearActiveSession()


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _in_bytes(df: DataFrame, most: int) -> DataFrame:
    def held(field):
        column = F.col(f"`{field.name}`")
        text = column if isinstance(field.dataType, (T.StringType, T.BinaryType)) else F.to_json(F.struct(column))
        error = F.raise_error(F.lit(f"a value of {field.name} is longer than {most} bytes"))
        return F.when(F.coalesce(F.octet_length(text), F.lit(0)) > most, error.cast(field.dataType)).otherwise(column).alias(field.name)

    unbounded = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)
    names = [f.name for f in df.schema.fields]
    if len(set(names)) < len(names):
        raise NotAReadOnlyQuery("two columns of the result have one name")
    return df.select(*[held(f) if isinstance(f.dataType, unbounded) else F.col(f"`{f.name}`") for f in df.schema.fields])


def check_query(plan, prefix: str = "", own: frozenset[str] = frozenset()) -> None:
    """Raise unless a parsed query is made of permitted parts only.

    ``own`` are the names the query has defined where this part stands. A name counts from the end of its definition to
    the end of its WITH; anywhere else, in its own definition too, it would be a table."""
    kind = plan.getClass().getSimpleName()
    if kind not in QUERY_NODES:
        raise NotAReadOnlyQuery(f"{kind} is not part of a read-only query")
    if kind == "UnresolvedRelation":
        _check_table([str(p).lower() for p in _items(plan.multipartIdentifier())], prefix, own)
    if kind == "UnresolvedWith":
        if plan.allowRecursion():
            raise NotAReadOnlyQuery("a recursive query is not bounded")
        for relation in _items(plan.cteRelations()):
            check_query(relation._2(), prefix, own)
            own = own | {str(relation._1()).lower()}
    for child in _items(plan.children()):
        check_query(child, prefix, own)
    expressions = _items(plan.expressions())
    while expressions:
        part = expressions.pop()
        kind = part.getClass().getSimpleName()
        if kind in CLOSED_EXPRESSIONS:
            raise NotAReadOnlyQuery(f"{kind} is not part of a read-only query")
        if kind == "UnresolvedFunction":
            name = ".".join(str(p).lower() for p in _items(part.nameParts()))
            if name not in FUNCTIONS:
                raise NotAReadOnlyQuery(f"function {name} is not open to queries")
        if kind in SUBQUERIES:
            check_query(part.plan(), prefix, own)
        elif "Subquery" in kind and kind != "InSubquery":
            raise NotAReadOnlyQuery(f"{kind} is not part of a read-only query")
        expressions += _items(part.children())


def _check_table(name: list[str], prefix: str, own: frozenset[str]) -> None:
    gold = LAKE_TABLES["gold"]
    table = name[-1] if len(name) == 1 or (len(name) == 2 and name[0] == f"{prefix}gold") else None
    dotted = name[0].split(".") if len(name) == 1 else []
    if not (table in gold or (len(name) == 1 and table in own) or (len(dotted) == 2 and dotted[0] == "gold" and dotted[1] in gold)):
        raise NotAReadOnlyQuery(f"table {'.'.join(name)} is not open to queries")
