"""JDBC: query and partitioned scans, and set-based writes through a staging table.

Rows reach the database in parallel through Spark's JDBC writer, into a
staging table that may be dropped and refilled safely.  One statement in one
transaction then moves them to the target, so a retry never half-applies.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from recordflow.operators import keyed
from recordflow.operators.schema import check_columns, match_name, plain_name

INSERT, UPDATE, UPSERT, INSERT_IGNORE, DELETE = "INSERT", "UPDATE", "UPSERT", "INSERT_IGNORE", "DELETE"

# --- fixed values ------------------------------------------------------------
DEFAULT_PRECISION, DEFAULT_SCALE = 10, 0
MAX_DIGITS_IN_BIGINT, MAX_DIGITS_IN_INT = 19, 9
DEFAULT_BATCH = 1000


@dataclass(frozen=True)
class Dialect:
    """Statement texts; override a method for a database that differs from the ANSI forms."""

    name: str = "ansi"
    quote: str = '"'
    types: dict = field(default_factory=lambda: {
        T.BooleanType: "BOOLEAN", T.ByteType: "SMALLINT", T.ShortType: "SMALLINT", T.IntegerType: "INTEGER",
        T.LongType: "BIGINT", T.FloatType: "REAL", T.DoubleType: "DOUBLE PRECISION", T.StringType: "VARCHAR(32672)",
        T.BinaryType: "BLOB", T.DateType: "DATE", T.TimestampType: "TIMESTAMP", T.TimestampNTZType: "TIMESTAMP",
    })
    operations: tuple = (INSERT, UPDATE, UPSERT, INSERT_IGNORE, DELETE)
    create_if_not_exists: bool = False

    def q(self, name: str) -> str:
        return self.quote + name.replace(self.quote, self.quote * 2) + self.quote

    def table(self, *parts: str | None) -> str:
        """Qualified, quoted name from catalog, schema and table (empty parts left out)."""
        return ".".join(self.q(p) for p in parts if p)

    def sql_type(self, dt: T.DataType) -> str:
        if isinstance(dt, T.DecimalType):
            return f"DECIMAL({dt.precision},{dt.scale})"
        if isinstance(dt, T.VarcharType):
            return f"VARCHAR({dt.length})"
        try:
            return self.types[type(dt)]
        except KeyError:
            raise ValueError(f"no column type for {dt.simpleString()}") from None

    def select(self, table: str, columns: str = "*", where: str | None = None, order_by: str | None = None,
               limit: int | None = None, offset: int | None = None) -> str:
        sql = f"SELECT {columns} FROM {table}"
        if where:
            sql += f" WHERE {where}"
        if order_by:
            sql += f" ORDER BY {order_by}"
        if offset:
            sql += f" OFFSET {offset} ROWS"
        if limit is not None:
            sql += f" FETCH NEXT {limit} ROWS ONLY"
        return sql

    def _on(self, keys: list[str]) -> str:
        return " AND ".join(f"t.{self.q(k)} = s.{self.q(k)}" for k in keys)

    def _set(self, columns: list[str], keys: list[str]) -> str:
        return ", ".join(f"{self.q(c)} = s.{self.q(c)}" for c in columns if c not in keys)

    def _insert(self, columns: list[str]) -> str:
        names = ", ".join(self.q(c) for c in columns)
        values = ", ".join(f"s.{self.q(c)}" for c in columns)
        return f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"

    def insert(self, target: str, staging: str, columns: list[str]) -> str:
        names = ", ".join(self.q(c) for c in columns)
        return f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging}"

    def update(self, target: str, staging: str, columns: list[str], keys: list[str]) -> str:
        if not set(columns) - set(keys):
            raise ValueError("an update needs a column that is not a key")
        return (f"MERGE INTO {target} t USING {staging} s ON {self._on(keys)} "
                f"WHEN MATCHED THEN UPDATE SET {self._set(columns, keys)}")

    def upsert(self, target: str, staging: str, columns: list[str], keys: list[str]) -> str:
        matched = f"WHEN MATCHED THEN UPDATE SET {self._set(columns, keys)} " if set(columns) - set(keys) else ""
        return f"MERGE INTO {target} t USING {staging} s ON {self._on(keys)} {matched}{self._insert(columns)}"

    def insert_ignore(self, target: str, staging: str, columns: list[str], keys: list[str]) -> str:
        return f"MERGE INTO {target} t USING {staging} s ON {self._on(keys)} {self._insert(columns)}"

    def delete(self, target: str, staging: str, columns: list[str], nullable: set[str] | None = None) -> str:
        """Rows equal to a staged row in every supplied column, nulls equal to nulls."""
        tests = []
        for c in columns:
            a, b = f"{target}.{self.q(c)}", f"s.{self.q(c)}"
            null_safe = nullable is None or c in nullable
            tests.append(f"({a} = {b} OR ({a} IS NULL AND {b} IS NULL))" if null_safe else f"({a} = {b})")
        return f"DELETE FROM {target} WHERE EXISTS (SELECT 1 FROM {staging} s WHERE {' AND '.join(tests)})"

    def create(self, target: str, schema: T.StructType, keys: list[str] = ()) -> str:
        cells = [f"{self.q(f.name)} {self.sql_type(f.dataType)}{'' if f.nullable and f.name not in keys else ' NOT NULL'}"
                 for f in schema.fields]
        if keys:
            cells.append(f"PRIMARY KEY ({', '.join(self.q(k) for k in keys)})")
        head = "CREATE TABLE IF NOT EXISTS" if self.create_if_not_exists else "CREATE TABLE"
        return f"{head} {target} ({', '.join(cells)})"

    def add_columns(self, target: str, fields: list[T.StructField]) -> list[str]:
        return [f"ALTER TABLE {target} ADD COLUMN {self.q(f.name)} {self.sql_type(f.dataType)}" for f in fields]


ANSI = Dialect()
DERBY = Dialect(name="derby", types={**ANSI.types, T.DoubleType: "DOUBLE"})


@dataclass(frozen=True)
class Database:
    """Where to connect; ``properties`` go to the driver."""

    url: str
    driver: str | None = None
    properties: dict = field(default_factory=dict)
    dialect: Dialect = ANSI

    def options(self) -> dict:
        out = {"url": self.url, **self.properties}
        if self.driver:
            out["driver"] = self.driver
        return out


# --------------------------------------------------------------------- scans
def scan_options(db: Database, query: str | None = None, table: str | None = None, fetch_size: int = 0,
                 timeout_seconds: int = 0, before: list[str] = ()) -> dict:
    out = {**db.options(), "fetchsize": str(fetch_size), "queryTimeout": str(timeout_seconds)}
    if query:
        out["query"] = query
    else:
        out["dbtable"] = table
    if before:
        out["sessionInitStatement"] = "; ".join(before)
    return out


def jdbc_query_scan(spark: SparkSession, db: Database, query: str, fetch_size: int = 0, timeout_seconds: int = 0,
                    before: list[str] = ()) -> DataFrame:
    """Rows of a SELECT; an empty result keeps its columns."""
    return spark.read.format("jdbc").options(**scan_options(db, query, None, fetch_size, timeout_seconds, before)).load()


def jdbc_partitioned_scan(spark: SparkSession, db: Database, table: str, column: str, lower, upper, partitions: int,
                          fetch_size: int = 0) -> DataFrame:
    """The table read by many tasks, each taking a range of ``column``."""
    return (
        spark.read.format("jdbc").options(**scan_options(db, None, table, fetch_size))
        .option("partitionColumn", column).option("lowerBound", str(lower)).option("upperBound", str(upper))
        .option("numPartitions", partitions).load()
    )


def value_type(sql_type: str, precision: int = 0, scale: int = 0, signed: bool = True, logical: bool = True,
               default_precision: int = DEFAULT_PRECISION, default_scale: int = DEFAULT_SCALE) -> T.DataType:
    """Column type for a JDBC result column; ``logical=False`` turns decimals and times into text."""
    name = sql_type.upper()
    if name in ("CHAR", "LONGNVARCHAR", "LONGVARCHAR", "NCHAR", "NVARCHAR", "VARCHAR", "CLOB", "NCLOB", "OTHER",
                "SQLXML", "ROWID"):
        return T.StringType()
    if name in ("BIT", "BOOLEAN"):
        return T.BooleanType()
    if name == "INTEGER":
        small = signed or 0 < precision < MAX_DIGITS_IN_INT
        return T.IntegerType() if small else T.LongType()
    if name in ("SMALLINT", "TINYINT"):
        return T.IntegerType()
    if name == "BIGINT":
        return T.StringType() if precision < 0 or precision > MAX_DIGITS_IN_BIGINT else T.LongType()
    if name in ("FLOAT", "REAL"):
        return T.FloatType()
    if name == "DOUBLE":
        return T.DoubleType()
    if name in ("DECIMAL", "NUMERIC"):
        if not logical:
            return T.StringType()
        p, s = (precision, scale if scale >= 0 else default_scale) if precision > 0 else (
            default_precision, scale if scale > 0 else default_scale)
        return T.DecimalType(max(p, s), s)
    if name in ("DATE", "TIME", "TIMESTAMP", "TIMESTAMP_WITH_TIMEZONE"):
        if not logical:
            return T.StringType()
        return {"DATE": T.DateType(), "TIME": T.LongType()}.get(name, T.TimestampNTZType())
    if name in ("BINARY", "VARBINARY", "LONGVARBINARY", "ARRAY", "BLOB"):
        return T.BinaryType()
    raise ValueError(f"unknown SQL type {sql_type!r}")


def jdbc_value_normalize(df: DataFrame, logical: bool = True, convert_names: bool = False) -> DataFrame:
    """Scan result in one projection: narrow integers to int, and without logical types
    decimals, dates and times to text."""
    cells = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType)):
            c = c.cast("int")
        elif not logical and isinstance(
            f.dataType, (T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)
        ):
            c = c.cast("string")
        cells.append(c.alias(plain_name(f.name) if convert_names else f.name))
    return df.select(*cells)


# --------------------------------------------------------------------- writes
@dataclass
class TableInfo:
    """What a write needs to know about its target."""

    columns: list[str]
    keys: list[str] = field(default_factory=list)
    required: list[str] = field(default_factory=list)
    nullable: set[str] = field(default_factory=set)


def resolve_keys(info: TableInfo, update_keys: list[str] | None) -> list[str]:
    """The given list, else the primary key, else an error."""
    wanted = update_keys or info.keys
    if not wanted:
        raise ValueError("the table has no primary key and no update keys were given")
    known = {match_name(c): c for c in info.columns}
    missing = [k for k in wanted if match_name(k) not in known]
    if missing:
        raise ValueError(f"update keys not in the table: {missing}")
    return [known[match_name(k)] for k in wanted]


@dataclass
class WritePlan:
    """Rows to stage, the one statement that applies them, and the rows that cannot be matched by key."""

    rows: DataFrame
    staging: str
    statement: str
    rejects: DataFrame


def plan_write(df: DataFrame, db: Database, target: str, info: TableInfo, operation: str, order: list[str] = (),
               update_keys: list[str] | None = None, extra: str = "ignore", missing: str = "fail",
               staging: str | None = None) -> WritePlan:
    """Check columns, keep the row of each key that wins, and build the set statement.

    Operations that pick a winner per key reject rows with a null key, which
    would otherwise count as rows of one key.  Rows of ``INSERT`` and ``DELETE``
    are all staged: the table's constraints decide about the former, and the
    latter matches null with null where the table allows nulls.
    """
    d, op = db.dialect, operation.upper()
    if op not in d.operations:
        raise ValueError(f"{op} is not supported by {d.name}")
    kept = check_columns(df.columns, [*info.columns, *order], (), extra)
    known = {match_name(c): c for c in info.columns}
    kept = [c for c in kept if match_name(c) in known]
    required = [] if op in (UPDATE, DELETE) else info.required
    kept = check_columns(kept, info.columns, required, "ignore", missing)
    rows = df.select(*[F.col(f"`{c}`").alias(known[match_name(c)]) for c in kept],
                     *[F.col(f"`{c}`") for c in order if match_name(c) not in known])
    columns = [known[match_name(c)] for c in kept]
    staging = staging or f"RF_{uuid.uuid4().hex[:16].upper()}"
    staged = d.table(staging)
    none = keyed.with_reason(rows.select(*columns).limit(0), keyed.NULL_KEY)
    if op == INSERT:
        return WritePlan(rows.select(*columns), staging, d.insert(target, staged, columns), none)
    if op == DELETE:
        return WritePlan(rows.select(*columns).distinct(), staging, d.delete(target, staged, columns, info.nullable or None), none)
    keys = resolve_keys(info, update_keys)
    absent = [k for k in keys if k not in columns]
    if absent:
        raise ValueError(f"the input lacks the key columns {absent}")
    rows, rejects = keyed.split_null_keys(rows, keys)
    if order:
        pick = keyed.first_per_key if op == INSERT_IGNORE else keyed.latest_per_key
        rows = pick(rows, keys, list(order))
    build = {UPDATE: d.update, UPSERT: d.upsert, INSERT_IGNORE: d.insert_ignore}[op]
    return WritePlan(rows.select(*columns), staging, build(target, staged, columns, keys), rejects.select(*columns, keyed.REASON))


def _connect(spark: SparkSession, db: Database):
    props = spark._jvm.java.util.Properties()
    for k, v in db.properties.items():
        props.setProperty(k, str(v))
    if db.driver:
        spark._jvm.java.lang.Class.forName(db.driver)
    return spark._jvm.java.sql.DriverManager.getConnection(db.url, props)


def run_statements(spark: SparkSession, db: Database, statements: list[str]) -> list[int]:
    """Run statements in one transaction; any error rolls all of them back."""
    con = _connect(spark, db)
    try:
        con.setAutoCommit(False)
        counts = []
        statement = con.createStatement()
        try:
            for sql in statements:
                counts.append(statement.executeUpdate(sql))
            con.commit()
        except Exception:
            con.rollback()
            raise
        finally:
            statement.close()
        return counts
    finally:
        con.close()


def jdbc_append(df: DataFrame, db: Database, table: str, batch_size: int = DEFAULT_BATCH, mode: str = "append",
                column_types: str | None = None) -> None:
    writer = df.write.format("jdbc").options(**db.options()).option("dbtable", table).option("batchsize", batch_size)
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.mode(mode).save()


def apply_write(plan: WritePlan, db: Database, batch_size: int = DEFAULT_BATCH) -> int:
    """Stage the rows, run the statement in one transaction, drop the staging table; returns affected rows."""
    spark = plan.rows.sparkSession
    staged = db.dialect.table(plan.staging)
    jdbc_append(plan.rows, db, staged, batch_size, "overwrite")
    try:
        return run_statements(spark, db, [plan.statement])[0]
    finally:
        run_statements(spark, db, [f"DROP TABLE {staged}"])


def jdbc_write(df: DataFrame, db: Database, target: str, info: TableInfo, operation: str, order: list[str] = (),
               batch_size: int = DEFAULT_BATCH, **kw) -> int:
    return apply_write(plan_write(df, db, target, info, operation, order, **kw), db, batch_size)


def jdbc_insert(df: DataFrame, db: Database, target: str, info: TableInfo, **kw) -> int:
    return jdbc_write(df, db, target, info, INSERT, **kw)


def jdbc_update(df: DataFrame, db: Database, target: str, info: TableInfo, **kw) -> int:
    return jdbc_write(df, db, target, info, UPDATE, **kw)


def jdbc_upsert(df: DataFrame, db: Database, target: str, info: TableInfo, **kw) -> int:
    return jdbc_write(df, db, target, info, UPSERT, **kw)


def jdbc_insert_ignore(df: DataFrame, db: Database, target: str, info: TableInfo, **kw) -> int:
    return jdbc_write(df, db, target, info, INSERT_IGNORE, **kw)


def jdbc_delete(df: DataFrame, db: Database, target: str, info: TableInfo, **kw) -> int:
    return jdbc_write(df, db, target, info, DELETE, **kw)


def evolve_statements(dialect: Dialect, target: str, incoming: T.StructType, existing: T.StructType | None,
                      keys: list[str] = ()) -> list[str]:
    """Statements that create an absent target, or add the columns it lacks."""
    if existing is None:
        return [dialect.create(target, incoming, keys)]
    have = {match_name(n) for n in existing.fieldNames()}
    return dialect.add_columns(target, [f for f in incoming.fields if match_name(f.name) not in have])


def jdbc_evolve_target(df: DataFrame, db: Database, target: str, existing: T.StructType | None,
                       keys: list[str] = (), batch_size: int = DEFAULT_BATCH) -> None:
    """Create or widen the target, then append."""
    statements = evolve_statements(db.dialect, target, df.schema, existing, keys)
    if statements:
        run_statements(df.sparkSession, db, statements)
    jdbc_append(df, db, target, batch_size)


# ----------------------------------------------------------------- parameters
# --- fixed values: JDBC type codes ------------------------------------------
BIT, BOOLEAN, TINYINT, SMALLINT, INTEGER, BIGINT = -7, 16, -6, 5, 4, -5
REAL, FLOAT, DOUBLE, DECIMAL, NUMERIC = 7, 6, 8, 3, 2
DATE, TIME, TIMESTAMP = 91, 92, 93
BINARY, VARBINARY, LONGVARBINARY = -2, -3, -4


def bound_value(type_code: int, value: str | None, fmt: str = "") -> Column:
    """A parameter's text as a typed literal expression."""
    from recordflow.functions import casts, timestamps as ts

    text = F.lit(value).cast("string")
    if type_code == BIT:
        return text.isin("1") | F.lower(text).isin("t", "true")
    if type_code == BOOLEAN:
        return F.lower(text) == "true"
    whole = {TINYINT: "tinyint", SMALLINT: "smallint", INTEGER: "int", BIGINT: "bigint"}
    if type_code in whole:
        return casts.to_integer(text, whole[type_code])
    if type_code == REAL:
        return casts.to_float(text)
    if type_code in (FLOAT, DOUBLE):
        return casts.to_double(text)
    if type_code in (DECIMAL, NUMERIC):
        scale = len(value.split(".")[1]) if value and "." in value and "e" not in value.lower() else 0
        return casts.to_decimal(text, 38, min(scale, 37))
    if type_code == DATE:
        return ts.parse_named(text, fmt) if fmt else F.coalesce(ts.cast_date(text), ts.cast_date(text, None))
    if type_code == TIME:
        return ts.parse_named(text, fmt) if fmt in ts.NAMED_FORMATS else ts.cast_time(text, fmt or "HH:mm:ss.SSS")
    if type_code == TIMESTAMP:
        return ts.parse_named(text, fmt) if fmt in ts.NAMED_FORMATS else ts.cast_timestamp(text, fmt or "yyyy-MM-dd HH:mm:ss.SSS")
    if type_code in (BINARY, VARBINARY, LONGVARBINARY):
        return casts.binary_decode(text, fmt or "ascii")
    return text


def bound_args(attributes: dict[str, str]) -> list[Column]:
    """``sql.args.N.type/.value/.format`` attributes as the positional arguments of a query."""
    numbers = sorted(int(k.split(".")[2]) for k in attributes if k.startswith("sql.args.") and k.endswith(".type"))
    if numbers != list(range(1, len(numbers) + 1)):
        raise ValueError(f"parameters must be numbered from 1 without gaps, found {numbers}")
    out = []
    for n in numbers:
        code = attributes[f"sql.args.{n}.type"]
        if not code.lstrip("-").isdigit():
            raise ValueError(f"sql.args.{n}.type is {code!r}, not a numeric SQL type")
        out.append(bound_value(int(code), attributes.get(f"sql.args.{n}.value"), attributes.get(f"sql.args.{n}.format", "")))
    return out


def sql_bound_params(spark: SparkSession, query: str, attributes: dict[str, str], **views: DataFrame) -> DataFrame:
    """A query with ``?`` markers, its typed parameters taken from attributes; a bad value is an error."""
    columns = bound_args(attributes)
    if columns:
        # one constant row: the typed values of the parameters
        names = [f"p{i}" for i in range(len(columns))]
        row = spark.range(1).select(*[c.alias(n) for c, n in zip(columns, names)]).first()
        for i, n in enumerate(names):
            if row[n] is None and attributes.get(f"sql.args.{i + 1}.value") is not None:
                raise ValueError(f"sql.args.{i + 1}.value does not fit its type")
        args = [row[n] for n in names]
    else:
        args = []
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(query, args=args)
