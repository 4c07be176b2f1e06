"""Avro container files and bare Avro rows, where Spark's Avro module is on the class path."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# --- fixed values -----------------------------------------------------------
CODECS = {"none": "uncompressed", "uncompressed": "uncompressed", "bzip2": "bzip2", "deflate": "deflate",
          "snappy": "snappy", "xz": "xz"}
PRIMITIVES = {"boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
              "double": T.DoubleType(), "string": T.StringType(), "bytes": T.BinaryType(), "null": T.NullType()}
LOGICAL = {"date": T.DateType(), "time-millis": T.LongType(), "time-micros": T.LongType(),
           "timestamp-millis": T.TimestampNTZType(), "timestamp-micros": T.TimestampNTZType(), "uuid": T.StringType()}


class AvroUnavailable(RuntimeError):
    pass


def available(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroFileFormat")
        return True
    except Exception:
        return False


def _need(spark: SparkSession) -> None:
    if not available(spark):
        raise AvroUnavailable("Spark's Avro module is not on the class path (package spark-avro)")


def codec(name: str) -> str:
    try:
        return CODECS[name.lower()]
    except KeyError:
        raise ValueError(f"unknown codec {name!r}; known: {sorted(CODECS)}") from None


def avro_write_embedded(df: DataFrame, path: str, schema: str | None = None, compression: str = "none",
                        mode: str = "errorifexists") -> None:
    """Container files that carry their schema."""
    name = codec(compression)
    _need(df.sparkSession)
    writer = df.write.format("avro").mode(mode).option("compression", name)
    if schema:
        writer = writer.option("avroSchema", schema)
    writer.save(path)


def avro_write_external(df: DataFrame, schema: str | None = None, compression: str = "none") -> DataFrame:
    """One binary Avro value per row; the schema travels elsewhere, so there is no codec."""
    if codec(compression) != "uncompressed":
        raise ValueError("rows without an embedded schema cannot be compressed")
    _need(df.sparkSession)
    from pyspark.sql.avro.functions import to_avro

    row: Column = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select((to_avro(row, schema) if schema else to_avro(row)).alias("value"))


# --------------------------------------------------------------- schema mapping
def _spark_type(node) -> tuple[T.DataType, bool, dict]:
    """(type, nullable, metadata) of an Avro schema node."""
    if isinstance(node, list):
        members = [n for n in node if n != "null"]
        if len(members) == 1:
            dt, _, meta = _spark_type(members[0])
            return dt, True, meta
        # a real union has no column type of its own: its values are kept as text
        return T.StringType(), "null" in node, {"union": [_name(m) for m in members]}
    if isinstance(node, str):
        return PRIMITIVES[node], False, {}
    kind, logical = node["type"], node.get("logicalType")
    if logical == "decimal":
        return T.DecimalType(node["precision"], node.get("scale", 0)), False, {}
    if logical in LOGICAL:
        return LOGICAL[logical], False, {"logicalType": logical}
    if kind == "record":
        return T.StructType([_field(f) for f in node["fields"]]), False, {}
    if kind == "array":
        dt, nullable, _ = _spark_type(node["items"])
        return T.ArrayType(dt, nullable), False, {}
    if kind == "map":
        dt, nullable, _ = _spark_type(node["values"])
        return T.MapType(T.StringType(), dt, nullable), False, {}
    if kind == "enum":
        return T.StringType(), False, {"symbols": node["symbols"]}
    if kind == "fixed":
        return T.BinaryType(), False, {}
    return _spark_type(kind)


def _name(node) -> str:
    return node if isinstance(node, str) else node.get("logicalType", node["type"])


def _field(f: dict) -> T.StructField:
    dt, nullable, meta = _spark_type(f["type"])
    meta = dict(meta)
    if f.get("aliases"):
        meta["aliases"] = f["aliases"]
    if f.get("default") is not None:
        meta["default"] = f["default"]
    return T.StructField(f["name"], dt, nullable, meta)


def schema_from_avro(text: str) -> T.StructType:
    """Spark schema of an Avro record schema; aliases, defaults and symbols go to the metadata."""
    dt, _, _ = _spark_type(json.loads(text))
    if not isinstance(dt, T.StructType):
        raise ValueError("an Avro record schema is needed")
    return dt


def _avro_type(dt: T.DataType, meta: dict, name: str):
    if meta.get("symbols"):
        return {"type": "enum", "name": f"{name}Enum", "symbols": list(meta["symbols"])}
    if isinstance(dt, T.StructType):
        return {"type": "record", "name": f"{name}Type", "fields": [_avro_field(f, name) for f in dt.fields]}
    if isinstance(dt, T.ArrayType):
        inner = _avro_type(dt.elementType, {}, name)
        return {"type": "array", "items": ["null", inner] if dt.containsNull else inner}
    if isinstance(dt, T.MapType):
        inner = _avro_type(dt.valueType, {}, name)
        return {"type": "map", "values": ["null", inner] if dt.valueContainsNull else inner}
    if isinstance(dt, T.DecimalType):
        if dt.precision == 38 and dt.scale == 0:
            return "string"   # an unbounded whole number
        return {"type": "bytes", "logicalType": "decimal", "precision": dt.precision, "scale": dt.scale}
    if isinstance(dt, T.DateType):
        return {"type": "int", "logicalType": "date"}
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return {"type": "long", "logicalType": meta.get("logicalType", "timestamp-micros")}
    if meta.get("logicalType") in ("time-millis", "time-micros"):
        base = "int" if meta["logicalType"] == "time-millis" else "long"
        return {"type": base, "logicalType": meta["logicalType"]}
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType)):
        return "int"
    for avro_name, spark_type in PRIMITIVES.items():
        if type(spark_type) is type(dt):
            return avro_name
    raise ValueError(f"no Avro type for {dt.simpleString()}")


def _avro_field(f: T.StructField, prefix: str) -> dict:
    from recordflow.operators.schema import valid_field_name

    meta = dict(f.metadata or {})
    name = valid_field_name(f.name)
    inner = _avro_type(f.dataType, meta, f"{prefix}_{name}" if prefix else name)
    out = {"name": name, "type": ["null", inner] if f.nullable else inner}
    aliases = [*meta.get("aliases", []), *([f.name] if name != f.name else [])]
    if aliases:
        out["aliases"] = aliases
    if meta.get("default") is not None:
        out["default"] = meta["default"]
        if f.nullable:
            out["type"] = [inner, "null"]   # a default belongs to the first branch
    return out


def schema_to_avro(schema: T.StructType, name: str = "record") -> str:
    return json.dumps({"type": "record", "name": name, "fields": [_avro_field(f, "") for f in schema.fields]})
