"""Queries that write tables through the sinks and read them back through the sources, and their SQL."""

from __future__ import annotations

import gzip
import re

from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import plugins as R
from ..sources import archives as A
from ..sources import files as S
from ..tables import shared_folder, table
from . import inputs as I


def _text(rows, column, path, files=None):
    (rows.coalesce(files) if files else rows).select(column.alias("value")).write.text(path)
    return path


def sequence_files(spark, sf):
    """Pages as a sequence file and back, the html passed through."""
    path = shared_folder(spark, "seq")
    S.write_sequence_file(table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("page_id"), "html"), path)
    return S.sequence_file(spark, path).select("page_id", F.md5(R.parse_by_type(F.col("html"), F.lit("text/plain"))).alias("digest"))


def text_paths(spark, sf):
    """Lines of two folders, given as one comma-joined path."""
    d = table(spark, sf, "documents")
    paths = [_text(d.where(F.col("lang") == lang), F.concat_ws("/", "lang", "source"), shared_folder(spark, "lines")) for lang in ("de", "fr")]
    return S.text_lines(spark, ",".join(paths)).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


def whole_files(spark, sf):
    """A file for each nation, read as one record without its line ends."""
    path = shared_folder(spark, "whole")
    n = table(spark, sf, "nation")
    n.select(F.concat("n_name", F.lit("\n"), F.col("n_nationkey").cast("string")).alias("value"), F.col("n_nationkey").alias("k")).repartition("k").write.partitionBy("k").text(path)
    return S.text_records(spark, f"{path}/k=*").select("html")


def manifest_lines(spark, sf):
    """S3: paths with and without a collection, comments and empty lines between them."""
    s = table(spark, sf, "supplier")
    key = F.col("s_suppkey").cast("string")
    line = F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit("# "), key)).when(F.col("s_suppkey") % 4 == 1, "").when(F.col("s_suppkey") % 4 == 2, F.concat(F.lit(" /a/"), key, F.lit("  web "))).otherwise(F.concat(F.lit("/b/"), key))
    return S.manifest(spark, _text(s, line, shared_folder(spark, "manifest")))


def registry_lines(spark, sf):
    """Registry lines of ten, nine and fewer parts, with zero dates and nulls."""
    r = I.registry(spark, sf)
    tag, zero = F.when(F.col("id_per") % 3 == 0, "t,").otherwise(""), F.when(F.col("id_org") % 2 == 0, "0000-00-00").otherwise("2001-02-03")
    full = F.concat(tag, F.col("id_per").cast("string"), F.lit(","), F.when(F.col("id_per") % 7 == 0, "\\N").otherwise(F.col("first_name")), F.lit(","), "last_name", F.lit(",1980-01-01,"), F.col("id_org").cast("string"), F.lit(","), "name_org", F.lit(",1999-01-01,"), zero, F.lit(",juht"))
    lines = spark.read.text(_text(r, F.when(F.col("id_per") % 11 == 0, "bad,line").otherwise(full), shared_folder(spark, "registry")))
    rows = S.parse_registry(lines)
    simple = S.simple_registry(lines).select("row_hash").distinct().withColumn("simple", F.lit(True))
    return rows.join(simple, "row_hash", "left").select("tag", "id_per", "first_name", "id_org", "end_date", "row_hash", F.coalesce("simple", F.lit(False)).alias("simple"))


def exclusion_lines(spark, sf):
    """Exclusion lines with a header, some of them short."""
    x = I.exclusions(spark, sf)
    line = F.when(F.length("synonym") > 0, F.concat_ws(",", "name", "tag1", "synonym")).otherwise(F.concat_ws(",", "name", "tag1"))
    lines = spark.read.text(_text(x, line, shared_folder(spark, "exclusions"))).union(spark.range(1).select(F.lit("name,tag1,synonym,tag2")))
    return S.parse_exclusions(lines)


def annotation_lines(spark, sf):
    """Names of each order as JSON lines, and as the annotator's own literals, with sentinels between them."""
    n = I.names(spark, sf).where("label <> 'LOC'").groupBy("page").agg(F.array_sort(F.collect_list(F.struct("entity", "label"))).alias("e"))
    quoted = lambda c: F.concat(F.lit("["), F.array_join(F.transform(F.col(c), lambda x: F.concat(F.lit("u'"), x, F.lit("'"))), ", "), F.lit("]"))
    key = F.col("page").cast("string")
    json = F.to_json(F.struct(key.alias("page_id"), F.struct(F.col("e.entity").alias("named_entities"), F.col("e.label").alias("named_entity_labels")).alias("ner")))
    literal = F.concat(F.lit("('"), key, F.lit("', {'ner': {'named_entities': "), quoted("e.entity"), F.lit(", 'named_entity_labels': "), quoted("e.label"), F.lit("}})"))
    none = F.concat(F.lit("('"), key, F.lit("', 'NO_TEXT')"))
    line = F.when(F.col("page") % 5 == 0, none).when(F.col("page") % 2 == 0, json).otherwise(literal)
    return S.parse_annotations(spark.read.text(_text(n, line, shared_folder(spark, "notes"))))


def table_sink(spark, sf):
    """A table in new files of bounded size; whether a second write is refused."""
    path = shared_folder(spark, "table")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    S.write_new(orders, path, max_records=100)
    try:
        S.write_new(orders, path)
        refused = False
    except Exception as error:
        refused = "exist" in str(error).lower()
    held = spark.read.schema(orders.schema).parquet(path)  # each file is opened once
    files = held.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))
    return files.agg(F.sum("n").alias("n"), F.sum("keys").alias("keys"), F.max("n").alias("most")).select(F.coalesce("n", F.lit(0)).alias("n"), "keys", (F.col("most") <= 100).alias("bounded"), F.lit(refused).alias("refused"))


def crawl_dump(spark, sf):
    """Crawl records as separated lines with a header, and back."""
    path = shared_folder(spark, "dump")
    S.write_dump(table(spark, sf, "pages").select("url", (F.col("page_id") % 6 + 1).alias("status")), path)
    return spark.read.csv(path, sep=";", header=True).select("url", F.col("status").cast("bigint").alias("status"))


def segment_parts(spark, sf):
    """Two parts of two segments, and the rows of one key in all of them."""
    path = shared_folder(spark, "segments")
    p = table(spark, sf, "pages").select("page_id", "url", F.md5("html").alias("value"))
    for k in range(2):
        rows = p.where(F.col("page_id") % 2 == k)
        S.write_segment({"content": rows.select("url", "value"), "fetch": rows.select("url", F.col("page_id").cast("string").alias("value"))}, path, f"s{k}")
    parts = [spark.read.parquet(f"{path}/{x}").withColumn("part", F.lit(x)) for x in ("content", "fetch")]
    return parts[0].unionByName(parts[1]).select("segment", "part", "url", "value")


def merged_ranges(spark, sf):
    """Three sorted tables as one: rows, and places where the order of a partition or of the ranges is broken."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    out = S.merge_sorted([o.where(F.col("o_orderkey") % 3 == k) for k in range(3)], "o_orderkey").withColumn("part", F.spark_partition_id()).withColumn("i", F.monotonically_increasing_id())
    from pyspark.sql import Window as W

    path = shared_folder(spark, "merged")
    out.write.parquet(path)
    rows = spark.read.parquet(path)
    inside = rows.withColumn("broken", (F.lag("o_orderkey").over(W.partitionBy("part").orderBy("i")) > F.col("o_orderkey")).cast("int")).agg(F.count("*").alias("n"), F.coalesce(F.sum("broken"), F.lit(0)).alias("inside"))
    ranges = rows.groupBy("part").agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))
    across = ranges.alias("a").join(ranges.alias("b"), F.expr("b.part > a.part and b.lo < a.hi")).agg(F.count("*").alias("across"))  # ranges, as many as partitions
    return inside.join(F.broadcast(across))


def failed_ledger(spark, sf):
    """Files that failed, added to a ledger in two turns; those that a third turn may skip."""
    path = shared_folder(spark, "ledger")
    n = table(spark, sf, "pages").select(F.col("url").alias("path"), "page_id")
    for k in (2, 3):
        S.append_ledger(n.where(F.col("page_id") % k == 0), path)
    return spark.read.parquet(path).groupBy("path").agg(F.count("*").alias("turns"))


def _archive(rows, path, kind, suffix):
    """Records, one file for each partition, written by the executors into the shared folder."""

    def write(batches):
        import uuid

        from pyarrow import fs

        store, place = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path if re.match("^[a-z0-9]+:/", path) else f"file://{path}"))
        store.create_dir(place, recursive=True)
        n = 0
        with store.open_output_stream(f"{place}/{uuid.uuid4().hex}{suffix}", compression=None) as out:
            for batch in batches:
                for number, url, html in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    body = f"HTTP/1.1 {200 if number % 4 else 404} OK\r\nContent-Type: text/html; charset={'windows-1252' if number % 2 else 'utf-8'}\r\n\r\n".encode() + html.encode("windows-1252" if number % 2 else "utf-8", "replace")
                    if kind == "warc":
                        said = "no number" if number % 10 == 9 else str(len(body))
                        record = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {url}\r\nWARC-Date: 2016-01-02T03:04:05Z\r\nContent-Length: {said}\r\n\r\n".encode() + body + b"\r\n\r\n"
                    else:
                        record = f"{url} 1.2.3.4 20160102030405 text/html {len(body)}\n".encode() + body + b"\n"
                    out.write(gzip.compress(record) if suffix.endswith(".gz") else record)
                    n += 1
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array([n])], ["n"])

    rows.select("page_id", "url", "html").mapInArrow(write, "n long").agg(F.sum("n")).collect()
    return A.read_archives(rows.sparkSession, path)


def warc_pages(spark, sf):
    """Responses of gzipped archives that were accepted, and records with no readable length."""
    found = _archive(table(spark, sf, "pages"), shared_folder(spark, "warc"), "warc", ".warc.gz")
    bad = found.where("type = 'malformed'").select(F.col("url").alias("key"), F.lit("malformed").alias("digest"))
    return A.responses(found).select(F.col("page_id").alias("key"), F.md5("html").alias("digest")).union(bad)


def arc_pages(spark, sf):
    """The same pages in the older format, not packed."""
    found = _archive(table(spark, sf, "pages"), shared_folder(spark, "arc"), "arc", ".arc")
    return found.select("url", "ip", "date14", F.col("status").cast("bigint").alias("status"), "mime", F.col("length").cast("bigint").alias("length"))


def xml_topics(spark, sf):
    """An XML file of links, read by Spark's own source and filtered by topic."""
    path = shared_folder(spark, "xml")
    p = table(spark, sf, "pages")
    line = F.concat(F.lit("<ExternalPage><about>"), F.regexp_replace("url", "&", "&amp;"), F.lit("</about><topic>Top/"), (F.col("page_id") % 4).cast("string"), F.lit("</topic></ExternalPage>"))
    lines = spark.sql("select 0 as i, '<RDF>' as value union all select 2, '</RDF>'").union(p.select(F.lit(1), line))
    lines.repartition(1).sortWithinPartitions("i").select("value").write.text(path)
    rows = S.xml_rows(spark, path, "ExternalPage", "about string, topic string")
    return rows.where(F.rlike("topic", F.lit("^Top/[12]$"))).select(F.col("about").alias("url"), "topic")


def modified_headers(spark, sf):
    """Last-modified headers in five formats, and one that is none."""
    day = F.timestamp_seconds(F.lit(1451606400) + F.col("page_id") * 86400)
    shapes = [F.date_format(day, f) for f in ("EEE, dd MMM yyyy HH:mm:ss 'GMT'", "EEEE, dd-MMM-yy HH:mm:ss 'GMT'", "EEE MMM d HH:mm:ss yyyy", "yyyy-MM-dd HH:mm:ss", "yyyyMMddHHmmss")]
    text = F.element_at(F.array(*shapes, F.lit("some day")), (F.col("page_id") % 6 + 1).cast("int"))
    return table(spark, sf, "pages").select("page_id", F.date_format(S.last_modified(text), "yyyyMMddHHmmss").alias("date14"))


def surface_forms(spark, sf):
    """The surface of the first long word of each text, by its span."""
    d = table(spark, sf, "documents")
    word = F.regexp_extract("text", "([A-Za-z]{6,})", 1)
    start = F.instr("text", word) - 1
    return d.where(word != "").select("doc_id", N.surface(F.col("text"), start, start + F.length(word)).alias("surface"), start.cast("bigint").alias("start"))


_REG = "reg as (select distinct o_custkey as p, l_suppkey as o from lineitem join orders on l_orderkey = o_orderkey), ln as (select *, case when p % 3 = 0 then 't' end as tag, case when p % 7 = 0 then '\\N' else 'Mari' || (p % 97) end as f, 'Tamm' || (p % 13) as l, 'Firma ' || (o % 71) || case when o % 3 = 0 then ' Osaühing' else ' AS' end as name, case when o % 2 = 0 then '0000-00-00' else '2001-02-03' end as z from reg where p % 11 <> 0)"
_ORG = "case when l_suppkey % 3 = 0 then 'OÜ ' else '' end || 'Firma ' || (l_suppkey % 71) || case when l_suppkey % 3 = 0 then '' else ' AS' end"

QUERIES = {f.__name__: f for f in (sequence_files, text_paths, whole_files, manifest_lines, registry_lines, exclusion_lines, annotation_lines, table_sink, crawl_dump, segment_parts, merged_ranges, failed_ledger, warc_pages, arc_pages, xml_topics, modified_headers, surface_forms)}
SQL = {
    "sequence_files": "select cast(page_id as varchar) as page_id, md5(html) as digest from pages",
    "text_paths": "select lang || '/' || source as line, count(*) as n from documents where lang in ('de', 'fr') group by 1",
    "whole_files": "select n_name || n_nationkey as html from nation",
    "manifest_lines": "select case when s_suppkey % 4 = 2 then '/a/' else '/b/' end || s_suppkey as path, case when s_suppkey % 4 = 2 then 'web' end as collection from supplier where s_suppkey % 4 >= 2",
    "registry_lines": f"with {_REG} select tag, cast(p as varchar) as id_per, nullif(f, '\\N') as first_name, cast(o as varchar) as id_org, nullif(z, '0000-00-00') as end_date, md5(case when tag is null then '' else 't,' end || p || ',' || f || ',' || l || ',1980-01-01,' || o || ',' || name || ',1999-01-01,' || z || ',juht') as row_hash, f <> '\\N' as simple from ln",
    "exclusion_lines": "select distinct p_name as name, case length(p_name) % 4 when 0 then 'loc' when 1 then 'synonym' else 'multi' end as tag1, case when length(p_name) % 4 = 1 then 'Firma 7 AS' else '' end as synonym, '' as tag2 from part",
    "annotation_lines": f"select cast(o_orderkey as varchar) as page, 'PER' as label, 'Mari' || (o_custkey % 97) || ' Tamm' || (o_custkey % 13) || case when o_custkey % 5 = 0 then '|Tammo' else '' end as entity from orders where o_orderkey % 5 <> 0 union all select cast(l_orderkey as varchar), 'ORG', {_ORG} from lineitem where l_orderkey % 5 <> 0",
    "table_sink": "select count(*) as n, sum(o_orderkey) as keys, true as bounded, true as refused from orders",
    "crawl_dump": "select url, page_id % 6 + 1 as status from pages",
    "segment_parts": "select 's' || (page_id % 2) as segment, part, url, case part when 'content' then md5(html) else cast(page_id as varchar) end as value from pages, (select unnest(['content', 'fetch']) as part)",
    "merged_ranges": "select count(*) as n, 0 as inside, 0 as across from orders",
    "failed_ledger": "select url as path, sum(case when page_id % 2 = 0 then 1 else 0 end + case when page_id % 3 = 0 then 1 else 0 end) as turns from pages where page_id % 2 = 0 or page_id % 3 = 0 group by 1",
    "modified_headers": "select page_id, case when page_id % 6 < 5 then strftime(timestamp '2016-01-01' + to_days(cast(page_id as integer)), '%Y%m%d%H%M%S') end as date14 from pages",
    "xml_topics": "select url, 'Top/' || (page_id % 4) as topic from pages where page_id % 4 in (1, 2)",
    "warc_pages": f"select case when page_id % 10 = 9 then url else lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) || '::' || lower(regexp_extract(url, '://([^/?#:]*)', 1)) || '::' || regexp_extract(url, '://[^/?#]*([^?#]*)', 1) || '::' || case when contains(url, '?') then regexp_extract(url, '\\?([^#]*)', 1) else 'null' end || '::20160102030405' end as key, case when page_id % 10 = 9 then 'malformed' else md5(html) end as digest from pages where page_id % 4 > 0 or page_id % 10 = 9",
    "arc_pages": "select url, '1.2.3.4' as ip, '20160102030405' as date14, case when page_id % 4 = 0 then 404 else 200 end as status, 'text/html' as mime, case when page_id % 2 = 1 then length(html) else strlen(html) end as length from pages",
    "surface_forms": "select doc_id, regexp_extract(text, '([A-Za-z]{6,})', 1) as surface, instr(text, regexp_extract(text, '([A-Za-z]{6,})', 1)) - 1 as start from documents where regexp_matches(text, '[A-Za-z]{6,}')",
}
