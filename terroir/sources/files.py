"""Scans and sinks of files, all by Spark's own readers and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terroir.functions.text import collapse_spaces, decode_entities, unicode_normalize
from terroir.operators.common import dealt, require_columns, scratch

BOM = "\ufeff"


def scan_csv(spark: SparkSession, path: str, required: list[str], encoding: str = "UTF-8", multi_line: bool = True) -> DataFrame:
    """A CSV with header: all columns are strings, missing cells are empty, rows without any cell go, and a byte order
    mark before the first name goes. Missing required columns are an error. With ``multi_line`` cells may hold line
    breaks, and a file is one task; without, large files are split."""
    df = spark.read.options(header=True, quote='"', escape='"', multiLine=multi_line, encoding=encoding, mode="PERMISSIVE").csv(path)
    df = df.toDF(*[c.lstrip(BOM).strip() for c in df.columns])
    require_columns(df, *required)
    filled = df.filter(F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in df.columns]).isNotNull())
    return filled.select(*[F.coalesce(c, F.lit("")).alias(c) for c in df.columns])


def write_csv(df: DataFrame, path: str, fields: list[str], bom: bool = True) -> None:
    """Chosen columns in order; cells are quoted only where they must be. A byte order mark is put before the header."""
    named = df.select(*[F.coalesce(F.col(f).cast("string"), F.lit("")).alias((BOM if bom and i == 0 else "") + f) for i, f in enumerate(fields)])
    named.write.options(header=True, quote='"', escape='"', emptyValue="").csv(path)


def scan_dictionary(spark: SparkSession, path: str, names: dict[str, str]) -> DataFrame:
    """A goods dictionary: columns renamed, text in NFC and trimmed, blank items and classes dropped, zeros of classes
    kept."""
    raw = scan_csv(spark, path, list(names))
    df = raw.select(*[unicode_normalize(F.trim(c)).alias(n) for c, n in names.items()])
    return df.filter((F.col("item") != "") & (F.col("class") != ""))


def scan_region_master(spark: SparkSession, path: str, level: str | None = None) -> DataFrame:
    """Rows of a hierarchy (code, province, region, town, village) without the lower levels, with their level."""
    df = scan_csv(spark, path, ["code", "province", "region", "town", "village"]).filter((F.col("town") == "") & (F.col("village") == ""))
    df = df.select("code", "province", "region", F.when(F.col("region") == "", "province").otherwise("region").alias("level"))
    return df.filter(F.col("level") == level) if level else df


HIT = T.ArrayType(T.StructType([T.StructField("number", T.StringType()), T.StructField("status", T.StringType())]))


def scan_match_document(spark: SparkSession, path: str, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """Entries (idx, query_key) and hits (query_key, pos, number, status) of a document, whichever layout it has: hits
    under each entry, or facts by query key that entries refer to. ``multi_line``: a file is one document, not one a line."""
    entry = T.StructType([T.StructField("idx", T.LongType()), T.StructField("query_key", T.StringType()), T.StructField("hits", HIT)])
    schema = T.StructType([T.StructField("results", T.ArrayType(entry)), T.StructField("queryFacts", T.MapType(T.StringType(), T.StructType([T.StructField("hits", HIT)]))), *entry.fields])
    doc = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    wrapped = doc.select(F.explode("results").alias("e")).select("e.*")
    bare = doc.filter(F.col("results").isNull() & F.col("idx").isNotNull()).select("idx", "query_key", "hits")
    entries = wrapped.unionByName(bare)
    facts = doc.select(F.explode("queryFacts").alias("query_key", "f")).select("query_key", F.posexplode("f.hits").alias("pos", "h"))
    own = entries.dropDuplicates(["query_key"]).select("query_key", F.posexplode("hits").alias("pos", "h"))
    return entries.select("idx", "query_key"), facts.unionByName(own).select("query_key", "pos", "h.number", "h.status")


def scan_xml_items(spark: SparkSession, path: str, row_tag: str, names: dict[str, str], root_tag: str = "response") -> DataFrame:
    """Repeated elements of XML pages as rows, tags renamed to columns."""
    schema = T.StructType([T.StructField(t, T.StringType()) for t in names])
    return spark.read.format("xml").schema(schema).options(rowTag=row_tag).load(path).select(*[F.trim(F.coalesce(t, F.lit(""))).alias(n) for t, n in names.items()])


def xml_headers(pages: DataFrame, column: str) -> DataFrame:
    """Header fields of landed XML pages: result_code, total, message. Pages are dealt in turn before they are parsed,
    since many may lie in one file; the fields come from a generator, so that a filter on them doesn't parse again."""
    x = lambda p: F.nullif(F.xpath_string(F.col(column), F.lit(p)), F.lit(""))
    fields = F.struct(x("//resultCode").alias("result_code"), x("//totalCount").try_cast("long").alias("total"), x("//resultMsg").alias("message"))
    return dealt(pages).select("*", F.inline(F.array(fields)))


def xml_goods(pages: DataFrame, column: str, schema: str = "asignProduct array<struct<classCode:string,name:string>>") -> DataFrame:
    """Nested goods of XML records, one row each."""
    return pages.withColumn("__x", F.from_xml(F.col(column), schema)).select(*pages.columns, F.explode("__x.asignProduct").alias("g")).select(*pages.columns, F.col("g.classCode").alias("class_code"), F.col("g.name").alias("goods"))


def valid_responses(headers: DataFrame, denied: str = "(?i)denied|not registered|권한|거부") -> tuple[DataFrame, DataFrame]:
    """Responses, and rejects with a reason. Code 20 means no result as well as refused access: only the first is a
    response of no rows."""
    refused = (F.col("result_code") == "20") & F.coalesce(F.col("message").rlike(denied), F.lit(False))
    bad = refused | ~F.col("result_code").isin("00", "20")
    return headers.filter(~F.coalesce(bad, F.lit(True))), headers.filter(F.coalesce(bad, F.lit(True))).withColumn("reason", F.when(refused, "denied").otherwise("error"))


def json_list(column: Column, fields: str) -> Column:
    """A JSON field that is an object or a list of objects, as a list of structs."""
    many, one = F.from_json(column, f"array<struct<{fields}>>"), F.from_json(column, f"struct<{fields}>")
    listed = F.substring(F.ltrim(column), 1, 1) == "["
    return F.when(listed, many).when(column.isNotNull(), F.array(one)).otherwise(F.array().cast(f"array<struct<{fields}>>"))


def scan_registry_json(df: DataFrame, column: str) -> DataFrame:
    """Applicants and goods of landed registry records, each as a list."""
    item = lambda k: F.get_json_object(column, f"$.{k}")
    return df.select(*[c for c in df.columns if c != column], item("number").alias("number"), json_list(item("applicant"), "name:string,address:string").alias("applicants"), json_list(item("goods"), "name:string").alias("goods"))


def scan_grid_json(df: DataFrame, column: str, root: str, names: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows of a dataset below ``root`` (an object or a list), renamed; documents with another result code are rejects."""
    code = F.get_json_object(column, f"$.{root}.result.code")
    ok = F.coalesce(code == "INFO-000", F.lit(False))
    rows = df.filter(ok).select(F.explode(json_list(F.get_json_object(column, f"$.{root}.row"), ",".join(f"{c}:string" for c in names))).alias("r"))
    return rows.select(*[F.col(f"r.{c}").alias(n) for c, n in names.items()]), df.filter(~ok).select(code.alias("code"), column)


def scan_html_list(df: DataFrame, column: str, tag: str = "li", pairs: bool = False) -> DataFrame:
    """Cells of a tag in order, without tags and entities; with ``pairs`` each even cell beside the next odd one."""
    cells = F.regexp_extract_all(F.col(column), F.lit(f"(?is)<{tag}[^>]*>(.*?)</{tag}>"), 1)
    rows = df.select(*[c for c in df.columns if c != column], F.posexplode(cells).alias("pos", "cell"))
    rows = rows.withColumn("cell", collapse_spaces(decode_entities(F.regexp_replace("cell", "(?s)<[^>]*>", " "))))
    if not pairs:
        return rows
    keys = [c for c in rows.columns if c not in ("pos", "cell")]
    return rows.groupBy(*keys, F.floor(F.col("pos") / 2).alias("pair")).agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("cell"))).alias("name"), F.max(F.when(F.col("pos") % 2 == 1, F.col("cell"))).alias("value"))


def scan_supplement(df: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """Records all of whose fields are filled, and the others as violations (which fields are blank)."""
    blank = F.array_compact(F.array(*[F.when(F.coalesce(F.trim(f), F.lit("")) == "", F.lit(f)) for f in fields]))
    marked = df.withColumn("blank", blank)
    return marked.filter(F.size("blank") == 0).drop("blank"), marked.filter(F.size("blank") > 0)


def flatten_map(df: DataFrame, column: str, expected: int | None = None) -> DataFrame:
    """MAP<key, ARRAY<STRUCT>> to rows; another count than expected is an error when the rows are read."""
    rows = df.select(F.explode(column).alias("key", "list")).select("key", F.explode("list").alias("item")).select("key", "item.*")
    if expected is None:
        return rows
    n = rows.agg(F.count(F.lit(1)).alias("__n"))
    return rows.crossJoin(F.broadcast(n)).filter(F.assert_true(F.col("__n") == expected).isNull()).drop("__n")


def to_common_rows(df: DataFrame, mapping: dict[str, Column], source: str) -> DataFrame:
    """Any source in the common columns item, region, code, url, source."""
    return df.select(*[mapping.get(c, F.lit("")).cast("string").alias(c) for c in ("item", "region", "code", "url")], F.lit(source).alias("source"))


def nationwide_catalog(df: DataFrame, scope: str) -> DataFrame:
    return df.withColumns({"region": F.lit(""), "scope": F.lit(scope)})


def corroborated_region(df: DataFrame, title: str, region: str, tokens: Column) -> DataFrame:
    """The region stays only where the title begins with one of its tokens."""
    return df.withColumn(region, F.when(F.exists(tokens, lambda x: F.startswith(F.col(title), x)), F.col(region)).otherwise(""))


def flatten_catalog(major: DataFrame, minor: DataFrame, detail: DataFrame) -> DataFrame:
    """major (major, major_name), minor (minor, major, minor_name), detail (minor, detail_name): one row per minor entry
    or detail, the detail's name before the minor's."""
    return minor.join(major, "major").join(detail, "minor", "left").select("major_name", "minor", F.coalesce(F.nullif("detail_name", F.lit("")), "minor_name").alias("name"))


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_cache(df: DataFrame, path: str, key: str, contract: str) -> None:
    """Complete and found entries only, with the contract they follow, in order of the key within files."""
    df.filter((F.col("status") == "complete") & F.col("found")).withColumn("contract_version", F.lit(contract)).sortWithinPartitions(key).write.parquet(path)


def read_cache(spark: SparkSession, path: str, contract: str) -> DataFrame:
    df = require_columns(spark.read.parquet(path), "status", "found", "contract_version")
    return df.filter((F.col("contract_version") == contract) & (F.col("status") == "complete") & F.col("found")).drop("contract_version")


def write_query_facts(df: DataFrame, path: str) -> None:
    df.write.partitionBy("status").parquet(path)


def read_query_facts(spark: SparkSession, path: str, status: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.filter(F.col("status") == status) if status else df
