"""Documents and config tables derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docalign.operators.config import field_map, rules, target_schema, value_map
from docalign.sources.documents import table_to_documents

BASE_URL = "https://example.org/browse/"
HINTS = {"code": "Must be LC- and three digits, such as LC-001", "total": "Digits only"}
VERSION_LABELS = {"v0": "Version 0 (2019)", "v1": "Version 1 (2021)"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows of one task: what a task reads and how long it runs does not grow with the table.
ROWS_A_TASK = 50_000


def tasks_for(rows: DataFrame) -> int:
    """At least one task a core, and more for large tables; counting a table reads its footers only."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS_A_TASK))


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows of a small file on all cores: a number of partitions that is given is not put together again."""
    return rows.repartition(tasks_for(rows), key)


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """The table of parts, on all cores: a file or a document made of a row costs far more than reading it."""
    return spread(table(spark, folder, "part"), "p_partkey")


def suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "supplier"), "s_suppkey")


# --- order documents ------------------------------------------------------------

FIELD_MAP = field_map(
    {
        "order_priority": "priority_level",
        "priority": "priority_level",
        "order_status": "status_code",
        "total": "amount",
        "is_large": "is_large_order",
        "clerk": "clerk_name",
        "segment": "segment",
        "order_date": "order_date",
        "legacy_code": "code",
    }
)

VALUE_MAP = value_map(
    {
        "priority_level": {
            "1-URGENT": "Urgent",
            "2-HIGH": "High",
            "3-MEDIUM": ["Medium"],
            "4-NOT SPECIFIED": None,
            "5-LOW": ["Low", "Lowest"],
        },
        "status_code": {"F": 1, "O": 2, "P": []},
        "is_large_order": {"True": "Yes", "False": "No"},
        "clerk_name": {"": None, "None": "never"},
        "segment": {},
    }
)

RULES = rules(
    [
        {
            "when": {
                "__must__": [
                    {"order_status": "O"},
                    {"__should__": [{"segment": "BUILDING"}, {"segment": "MACHINERY"}]},
                ]
            },
            "then": {"channel": "direct"},
        },
        {"when": {}, "then": {"source_system": "orders"}},
        {"when": {"__should__": [{"clerk": None}]}, "then": {"clerk_state": "unknown"}},
        {"when": {"__must__": [{"is_large": True}]}, "then": {"order_priority": "1-URGENT"}},
        {"when": {"__must__": [{"order_priority": "1-URGENT"}]}, "then": {"expedite": "true"}},
        {"when": {"__should__": []}, "then": {"never": "x"}},
        {"when": {"__must__": []}, "then": {"source_system": "orders7"}},
        {
            "when": {"__must__": [{"order_status": "F", "segment": "FURNITURE"}]},
            "then": {"channel": "store"},
        },
        {
            "when": {"__must__": [{"order_status": "P"}], "__should__": [{"segment": "HOUSEHOLD"}]},
            "then": {"channel": "phone"},
        },
    ]
)


def _field(name, kind, required=False, regex=None, default=None, permissible=None):
    return {
        "name": name,
        "type": kind,
        "required": required,
        "regex": regex,
        "default_value": default,
        "permissible_values": permissible,
    }


SCHEMA = target_schema(
    [
        _field("priority_level", "categorical", True, permissible=["Urgent", "High", "Medium", "Low"]),
        _field("status_code", "categorical", permissible=[1, 2]),
        _field("amount", "number", True),
        _field("is_large_order", "categorical", True, permissible=["Yes", "No"]),
        _field("clerk_name", "text", True, default="nobody"),
        _field("segment", "categorical", permissible=["AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY"]),
        _field("order_date", "text", True, regex=r"\d{4}-\d{2}-\d{2}"),
        _field("code", "text", regex=r"LC-\d{3}"),
        _field("channel", "text", default="unknown"),
        _field("region", "text", True),
        _field("expedite", "text"),
        _field("source_system", "text", regex="("),
    ]
)


def order_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their customer's region and segment, as documents."""
    orders = table(spark, folder, "orders")
    # Spread behind the joins: where customers are many, these deal out the orders by customer.
    wide = (
        orders.join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .repartition(tasks_for(orders), "o_orderkey")
    )
    k = F.col("o_orderkey")
    clerk = (
        F.when(k % 5 == 2, F.lit(""))
        .when(k % 5 == 3, F.lit("  "))
        .when(k % 5 == 4, F.concat(F.lit("clerk-"), (k % 100).cast("string")))
    )
    code = (
        F.when(k % 3 == 0, F.lit("LC-001")).when(k % 3 == 1, F.lit("lc 1")).otherwise(F.lit("LC-001\n"))
    )
    return table_to_documents(
        wide,
        {
            "id": k,
            "uuid": k.cast("string"),
            "record_id": F.concat(F.lit("ORD"), k.cast("string")),
            "status": F.when(F.col("o_orderstatus") == "F", F.lit("Published")).otherwise(F.lit("QA")),
            "group_name": F.col("r_name"),
            "dataset_type": F.col("c_mktsegment"),
        },
        [
            ("order_priority", F.col("o_orderpriority")),
            ("priority", F.lit("OVERRIDE"), k % 7 == 0),
            ("order_status", F.col("o_orderstatus")),
            ("status_code", F.lit("RAW"), k % 11 == 0),
            ("total", F.floor("o_totalprice")),
            ("is_large", F.col("o_totalprice") > 250000),
            ("clerk", clerk, k % 5 != 0),
            ("segment", F.col("c_mktsegment")),
            ("order_date", F.date_format("o_orderdate", "yyyy-MM-dd")),
            ("legacy_code", code),
            ("note", F.concat(F.lit("n"), (k % 10).cast("string"))),
        ],
    )


# --- documents of several profiles ----------------------------------------------------

# Two profiles with their own names and schema; a third has no config at all.
PROFILE_FIELD_MAP = field_map(
    {"order_priority": "level", "order_status": "state"}, profile="east"
) + field_map({"order_priority": "urgency", "segment": "state"}, profile="west")
PROFILE_SCHEMA = target_schema(
    [_field("level", "text"), _field("state", "text"), _field("site", "text", default="E1")], profile="east"
) + target_schema([_field("state", "text"), _field("urgency", "text")], profile="west")
PROFILE_VALUE_MAP = value_map({"state": {"F": "done", "BUILDING": "built"}}, profile="east") + value_map(
    {"state": {"F": "never", "BUILDING": "Building"}}, profile="west"
)
PROFILE_RULES = rules(
    [{"when": {"__must__": [{"order_status": "P"}]}, "then": {"order_status": "F"}}], profile="east"
)


def profile_documents(spark: SparkSession, folder: str) -> DataFrame:
    names = F.array(F.lit("east"), F.lit("west"), F.lit("none"))
    return order_documents(spark, folder).withColumn(
        "profile", F.get(names, (F.col("id") % 3).cast("int"))
    )


# --- event documents --------------------------------------------------------------

EVENT_FIELD_MAP = field_map({"k": "score"})
EVENT_VALUE_MAP = value_map({"score": {"0": None, "1": "one", "2": ["two", "deux"]}})


def event_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Events as document JSON texts around their own ``props``."""
    head = F.concat(
        F.lit('{"uuid":"'), F.col("event_id").cast("string"), F.lit('","group_name":"'), F.col("event_type")
    )
    return spread(table(spark, folder, "events"), "event_id").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("stem"),
        F.concat(F.lit("e"), F.col("event_id").cast("string"), F.lit(".json")).alias("source_file"),
        F.concat(head, F.lit('","metadata":'), F.col("props"), F.lit("}")).alias("content"),
    )


def changed_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with nested bodies before and after one of six changes, as JSON texts ``old`` and ``new``."""
    k = F.col("event_id")
    n = F.get_json_object("props", "$.k")
    number = lambda more: F.concat((n.cast("bigint") + more).cast("string"))
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    tags, deep = text('["x","y",', n, ',"z"]'), text('{"u":1,"v":[{"w":', n, '},{"w":0}]}')

    def body(props=F.col("props"), tags=tags, deep=deep, tail=',"n":1.50}'):
        return text('{"props":', props, ',"tags":', tags, ',"deep":', deep, tail)

    case = k % 6
    new = (
        F.when(case == 0, body())
        .when(case == 1, body(props=text('{"k":', number(1), "}")))
        .when(case == 2, body(tags=text('["x",', n, ',"z"]')))
        .when(case == 3, body(tags=text('["new","x","y","', n, '","z"]')))
        .when(case == 4, body(deep=text('{"v":[{"w":', n, '},{"w":', number(5), '}],"q~/":null}')))
        .otherwise(body(tags=F.lit('{"a":[]}'), tail="}"))
    )
    return spread(table(spark, folder, "events"), "event_id").select(k.alias("id"), body().alias("old"), new.alias("new"))


def broken_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Event texts of which most are damaged in one of several ways."""
    case = F.col("id") % 10
    good = F.col("content")
    return event_texts(spark, folder).withColumn(
        "content",
        F.when(case == 0, F.lit("{bad"))
        .when(case == 1, F.lit("[1]"))
        .when(case == 2, F.lit('{"uuid":"x","metadata":[1]}'))
        .when(case == 3, F.lit('{"uuid":"x"}'))
        .when(case == 4, F.lit('{"uuid":"x","metadata":null}'))
        .when(case == 5, F.lit('{"uuid":"x","metadata":{"a":1,"b":5,"a":2}}'))
        .when(case == 6, F.concat(good, F.lit(" tail")))
        .otherwise(good),
    )


def part_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as documents, each with a profile of its own; half of them lack a field."""
    k = F.col("p_partkey")
    return table_to_documents(
        parts(spark, folder),
        {
            "id": k,
            "profile": F.concat(F.lit("part-"), k.cast("string")),
            "record_id": F.concat(F.lit("P"), k.cast("string")),
            "group_name": F.col("p_brand"),
            "dataset_type": F.col("p_type"),
        },
        [("type", F.col("p_type")), ("brand", F.col("p_brand"), k % 2 == 0), ("size", F.col("p_size"))],
    )


# --- catalogs of config files -------------------------------------------------------


def crosswalk_files(spark: SparkSession, folder: str) -> DataFrame:
    """A catalog of crosswalk CSV texts, one per part.

    The parts of a brand are one profile. Legacy names come back in several
    files, some with no target and some quoted.
    """
    k = F.col("p_partkey")
    key = k.cast("string")
    lines = [
        F.lit("target,v0,v1"),
        F.concat(F.lit("size_"), (k % 4).cast("string"), F.lit(",size,p_size_"), (k % 9).cast("string")),
        F.concat(F.lit("  name , label_"), (k % 6).cast("string"), F.lit(" ,")),
        F.concat(F.when(k % 5 < 2, F.lit("")).otherwise(F.lit("note_text")), F.lit(",,note_"), (k % 5).cast("string")),
        F.lit(''),
        F.concat(F.lit('disk,5" disk,3" lbl\r')),
        F.lit('"two\nlines""",a"b,"c"d'),
        F.concat(F.lit('"kind, '), F.col("p_type"), F.lit('",type_of,"the ""type"""')),
        F.concat(F.lit("only_"), key),
    ]
    return parts(spark, folder).select(
        F.col("p_brand").alias("profile"),
        F.concat(F.lit("cw/"), F.lpad(key, 12, "0"), F.lit(".csv")).alias("source_file"),
        F.concat_ws("\n", *lines).alias("content"),
    )


def field_map_files(spark: SparkSession, folder: str) -> DataFrame:
    """A catalog of field map JSON texts; files of a profile disagree."""
    k = F.col("p_partkey")
    content = F.concat(
        F.lit('{"size":"size_'),
        (k % 4).cast("string"),
        F.lit('","name_'),
        (k % 7).cast("string"),
        F.lit('":"name","drop_'),
        (k % 3).cast("string"),
        F.lit('":'),
        F.when(k % 2 == 0, F.lit("null")).otherwise(F.lit('"kept"')),
        F.lit("}"),
    )
    return parts(spark, folder).select(
        F.col("p_brand").alias("profile"),
        F.concat(F.lit("fm/"), F.lpad(k.cast("string"), 12, "0"), F.lit(".json")).alias("source_file"),
        content.alias("content"),
    )


def value_map_files(spark: SparkSession, folder: str) -> DataFrame:
    """A catalog of value map JSON texts, nested and flat ones by turns."""
    k = F.col("p_partkey")
    size = F.col("p_size").cast("string")
    nested = F.concat(
        F.lit('{"grade":{"'), (k % 5).cast("string"), F.lit('":"g'), size, F.lit('","x":[1,2.50,"a"]}}')
    )
    flat = F.concat(F.lit('{"'), (k % 6).cast("string"), F.lit('":'), size, F.lit(',"f":35.0,"n":null}'))
    empty = F.lit('{"grade":{}}')
    return parts(spark, folder).select(
        F.col("p_brand").alias("profile"),
        F.concat(F.lit("vm/"), F.lpad(k.cast("string"), 12, "0"), F.lit("/grade.json")).alias("source_file"),
        F.lit("grade").alias("stem"),
        F.when(k % 7 == 0, empty).when(k % 3 == 0, nested).otherwise(flat).alias("content"),
    )


def rule_files(spark: SparkSession, folder: str) -> DataFrame:
    """A catalog of rule files, one per supplier, with none to two rules."""
    k = F.col("s_suppkey")
    one = F.concat(
        F.lit('{"when":{"__must__":[{"nation":'), F.col("s_nationkey").cast("string"), F.lit('}]},"then":{"zone":"z'),
        (k % 3).cast("string"), F.lit('"}}'),
    )
    content = (
        F.when(k % 3 == 0, F.lit("[]"))
        .when(k % 3 == 1, F.concat(F.lit("["), one, F.lit("]")))
        .otherwise(F.concat(F.lit("["), one, F.lit(',{"when":{},"then":{"seen":true}}]')))
    )
    return suppliers(spark, folder).select(
        F.concat(F.lit("nation-"), F.col("s_nationkey").cast("string")).alias("profile"),
        F.concat(F.lit("rules/"), F.lpad(k.cast("string"), 12, "0"), F.lit(".json")).alias("source_file"),
        content.alias("content"),
    )


def part_rules(spark: SparkSession, folder: str) -> DataFrame:
    """A rule file for every part's profile, with nested conditions, and shared rules of three."""
    k, key = F.col("p_partkey"), F.col("p_partkey").cast("string")
    size = F.col("p_size").cast("string")
    # A size that the part has or not, written as another kind of number.
    other = F.when(k % 4 == 0, F.concat(size, F.lit(".0"))).otherwise(F.concat((F.col("p_size") + 1).cast("string"), F.lit("e0")))
    nested = F.concat(
        F.lit('{"when":{"__must__":[{"__should__":[{"type":"SMALL"},{"type":"ECONOMY"}]},{"__should__":[{"brand":null},{"size":'),
        other, F.lit('}]}]},"then":{"zone":"z'), (k % 3).cast("string"), F.lit('","n":'), key, F.lit("}}"),
    )
    seen = F.lit('{"when":{"__must__":[]},"then":{"seen":true}}')
    crossed = F.concat(
        F.lit('{"when":{"__should__":[{"__must__":[{"type":"ECONOMY"},{"size":'), size,
        F.lit('}]},{"__must__":[{"type":"LARGE"},{"size":-1}]},{"type":"SMALL","brand":"'), F.col("p_brand"),
        F.lit('"}]},"then":{"type":"T'), (k % 5).cast("string"), F.lit('","brand":"none"}}'),
    )
    never = F.lit('{"when":{"__should__":[]},"then":{"never":1}}')
    own = F.when(k % 3 == 1, F.concat_ws(",", nested, never, seen, crossed)).otherwise(F.concat_ws(",", nested, never, crossed))
    files = parts(spark, folder).select(
        F.concat(F.lit("part-"), key).alias("profile"), F.concat(F.lit("rules/"), key, F.lit(".json")).alias("source_file"),
        F.concat(F.lit("["), own, F.lit("]")).alias("content"),
    )
    shared = (
        '[{"when":{"__must__":[{"size":7}]},"then":{"lucky":true}},{"when":{},"then":{"source":"parts"}},'
        '{"when":{"__must__":[{"brand":null}],"__should__":[{"type":"SMALL"},{"size":null}]},"then":{"brand_state":"unknown"}}]'
    )
    return files.unionByName(
        spark.range(1).select(F.lit(None).cast("string").alias("profile"), F.lit("rules/all.json").alias("source_file"), F.lit(shared).alias("content"))
    )


def part_schemas(spark: SparkSession, folder: str) -> DataFrame:
    """A target schema for every part's profile: lists of mixed kinds, empty lists, thousands of patterns."""
    k, key = F.col("p_partkey"), F.col("p_partkey").cast("string")
    size = F.col("p_size").cast("string")
    brands = F.when(k % 6 == 0, F.lit("[]")).when(k % 6 == 2, F.concat(F.lit('["'), F.col("p_brand"), F.lit('","Brand#1"]'))).otherwise(F.lit('["Brand#1"]'))
    sizes = F.when(k % 2 == 0, F.concat(F.lit("["), size, F.lit('.0,"x",true]'))).otherwise(F.concat(F.lit('["'), size, F.lit('",true]')))
    pattern = (
        F.when(k % 5 == 0, F.lit(r"[0-3]?\\d"))
        .when(k % 5 == 1, F.lit(r"\\d"))
        .when(k % 5 == 2, F.lit("("))
        .when(k % 5 == 3, F.concat(size, F.lit("|"), key))
        .otherwise(F.concat(F.lit(r"\\d{2}|x{"), key, F.lit("}")))
    )
    content = F.concat(
        F.lit('[{"name":"type","required":true,"permissible_values":["SMALL","ECONOMY",'), (k % 7).cast("string"),
        F.lit('],"regex":"(?:SMALL|ECONOMY){1,'), (1 + k % 9).cast("string"), F.lit('}"},{"name":"brand","required":true,"permissible_values":'), brands,
        F.lit('},{"name":"size","default_value":'), key, F.lit(',"permissible_values":'), sizes, F.lit(',"regex":"'), pattern, F.lit('"}]'),
    )
    return parts(spark, folder).select(
        F.concat(F.lit("part-"), key).alias("profile"), F.concat(F.lit("schema/"), key, F.lit(".json")).alias("source_file"), content.alias("content")
    )


def schema_files(spark: SparkSession, folder: str) -> DataFrame:
    """A catalog of target schema texts, one profile per part."""
    k = F.col("p_partkey")
    content = F.concat(
        F.lit('[{"name":"size","type":"number","required":true,"default_value":'),
        F.col("p_size").cast("string"),
        F.lit('},"skipped",{"description":"no name"},{"name":"brand","permissible_values":["'),
        F.col("p_brand"),
        F.lit('",'),
        (k % 5).cast("string"),
        F.lit(',1.50]},{"name":"size","required":'),
        F.when(k % 2 == 0, F.lit("1")).otherwise(F.lit("false")),
        F.lit(',"regex":"\\\\d+"}]'),
    )
    return parts(spark, folder).select(
        F.concat(F.lit("part-"), k.cast("string")).alias("profile"),
        F.concat(F.lit("schema/"), k.cast("string"), F.lit(".json")).alias("source_file"),
        content.alias("content"),
    )


# The template field types, and one that is unknown.
CHILD_TYPES = [
    "text-field", "link-field", "controlled-term-field", "numeric-field", "radio-field", "checkbox-field",
    "date-field", "datetime-field", "email-field", "url-field", "rating-field",
]


def template_files(spark: SparkSession, folder: str) -> DataFrame:
    """A catalog of schema templates, one per customer with three fields."""
    k = F.col("c_custkey")
    key = k.cast("string")
    types = F.array(*[F.lit(t) for t in CHILD_TYPES])
    kind = F.get(types, (k % 11).cast("int"))
    named = F.when(k % 4 == 0, F.concat(F.lit('"key":"k'), key, F.lit('"'))).otherwise(
        F.concat(F.lit('"name":"n'), key, F.lit('","key":"other"'))
    )
    default = (
        F.when(k % 5 == 0, F.lit('"plain"'))
        .when(k % 5 == 1, F.lit('{"label":"L","value":"V"}'))
        .when(k % 5 == 2, F.lit('{"label":"","value":7}'))
        .when(k % 5 == 3, F.lit("2.5"))
        .otherwise(F.lit("null"))
    )
    values = (
        F.when(k % 3 == 0, F.concat(F.lit('[{"label":"'), F.col("c_mktsegment"), F.lit('"},{"termLabel":"T"},{"label":"007"},{"other":1}]')))
        .when(k % 3 == 1, F.concat(F.lit('["s",'), (k % 10).cast("string"), F.lit(',1.50,null,[1]]')))
        .otherwise(F.lit("[]"))
    )
    first = F.concat(
        F.lit("{"), named, F.lit(',"type":"'), kind, F.lit('","description":"about '), key,
        F.lit('","regex":"^a$","default":'), default, F.lit(',"values":'), values,
        F.when(k % 2 == 0, F.lit(',"configuration":{"required":true}')).otherwise(F.lit("")), F.lit("}"),
    )
    content = F.concat(
        F.lit('{"name":"t","children":['), first, F.lit(',{"type":"text-field"},"junk",{"name":"last"}]}')
    )
    return spread(table(spark, folder, "customer"), "c_custkey").select(
        F.concat(F.lit("template-"), key).alias("profile"), content.alias("content")
    )


# --- catalogs with broken files --------------------------------------------------------


def broken_catalogs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Config files by kind, one profile per supplier; some are broken, also a shared one."""
    k, key = F.col("s_suppkey"), F.col("s_suppkey").cast("string")
    case = k % 8

    def files(kind: str, content, only=F.lit(True)) -> DataFrame:
        return suppliers(spark, folder).where(only).select(
            F.concat(F.lit("s-"), key).alias("profile"),
            F.concat(F.lit(f"{kind}/"), F.lpad(key, 9, "0"), F.lit(".json")).alias("source_file"),
            F.lit("score").alias("stem"), content.alias("content"),
        )

    rule = F.concat(F.lit('[{"when":{"__must__":[{"k":1}]},"then":{"zone":"z'), key, F.lit('"}}]'))
    rules_text = (
        F.when(case == 0, F.lit('{"when":{},"then":{}}'))
        .when(case == 1, F.lit('[{"when":{},"then":{}},{"when":{"__must__":[{"__should__":[{"__must__":7}]}]},"then":{}}]'))
        .when(case == 2, F.lit('[{"when":{}}]'))
        .otherwise(rule)
    )
    map_text = F.when(case == 3, F.lit("[1]")).when(case == 4, F.lit('{"k":"score"')).otherwise(F.lit('{"k":"score"}'))
    shared = spark.range(1).select(
        F.lit(None).cast("string").alias("profile"), F.lit("value-map/all.json").alias("source_file"),
        F.lit("score").alias("stem"), F.lit('"x"').alias("content"),
    )
    return {
        "rules": files("rules", rules_text),
        "field map": files("field-map", map_text),
        "value map": files("value-map", F.lit('{"1":"one","2":["two"]}'), k % 3 != 0).unionByName(shared),
        "schema": files("schema", F.when(case == 5, F.lit("{}")).otherwise(F.lit('[{"name":"score"},{"name":"zone"}]')), case > 4),
    }


def supplier_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Events, some damaged, by the profile of a supplier; some profiles have no config, some events no profile."""
    n = F.col("id") % 41
    profile = F.when(n != 40, F.concat(F.lit("s-"), n.cast("string")))
    return broken_texts(spark, folder).withColumn("profile", profile)
