"""The registered queries: every operator over the provided tables.

Each takes ``(spark, folder)`` and returns a frame; ``quire.plans.oracles`` has
the SQL that must give the same rows.  The tables stand in for the document
tables: ``doc_id`` names the file, ``lang`` is the category, ``source`` the
uploader.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable
from xml.sax.saxutils import escape

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quire.functions import text as tx
from quire.operators import answering, bm25, contract as ct, dense, expectations as ex
from quire.operators import layers, lineage, merge as mg, ranking, schema_guard, topk
from quire.operators.chunking import chunk_documents
from quire.plans import lakehouse, retrieval, search_store
from quire.session import materialize, prepare_session, scratch_path
from quire.sources import landing, topics
from quire.sources.tables import StoredTable
from quire.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def registered(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(prepare_session(spark), folder)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores where a source is stored in fewer pieces than there are.

    A no-op for a table of many files: nothing is shuffled there.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    pieces = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(cores) if pieces < cores else df


def file_name_of(doc_id: Column) -> Column:
    return F.concat(F.lit("doc_"), doc_id.cast("string"), F.lit(".txt"))



def _clock() -> Column:
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def _bronze(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread(table(spark, folder, "documents"))
    return docs.select(
        F.col("doc_id").cast("string").alias("document_id"),
        file_name_of(F.col("doc_id")).alias("file_name"),
        F.concat(F.lit("/in/"), F.col("doc_id").cast("string")).alias("file_path"),
        F.lit("txt").alias("file_type"),
        F.col("n_chars").alias("file_size_bytes"),
        F.col("lang").alias("category"),
        F.lit(None).cast("string").alias("course_code"),
        F.col("source").alias("uploaded_by"),
        F.lit("2024-01-01T00:00:00Z").alias("upload_timestamp"),
        F.col("text").alias("raw_text"),
        _clock().alias("bronze_ingested_at"),
    )


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    return layers.to_silver(_bronze(spark, folder), _clock())


def _silver_measures(spark: SparkSession, folder: str) -> DataFrame:
    """Silver without its texts, stored, for queries that read it repeatedly."""
    return materialize(_silver(spark, folder).drop("clean_text"), "silver")


def _chunks(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_documents(layers.retrievable_rows(_silver(spark, folder)))


def _items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _user_turns(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").filter("role = 'user'")
    return turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "text")


def _search_index(spark: SparkSession, folder: str) -> retrieval.SearchIndex:
    return retrieval.build_search_index(_chunks(spark, folder))


# --- layers and aggregations ---------------------------------------------------


@registered
def a1_gold_rollup(spark, folder):
    return layers.to_gold(_silver(spark, folder)).drop("last_updated_at")


@registered
def a1_rollup_lineitem(spark, folder):
    names = ("line_count", "total_quantity", "avg_quantity", "suppliers", "last_shipped")
    out = layers.rollup(
        table(spark, folder, "lineitem"), "l_returnflag", "l_quantity", "l_suppkey", "l_shipdate", names
    )
    return out.withColumn("last_shipped", F.date_format("last_shipped", "yyyy-MM-dd HH:mm:ss"))


@registered
def a4_extraction_coverage(spark, folder):
    return layers.extraction_coverage(_extracted(spark, folder))


@registered
def a5_layer_counts(spark, folder):
    silver = _silver_measures(spark, folder)
    return layers.layer_counts(bronze=table(spark, folder, "documents"), silver=silver, gold=layers.to_gold(silver))


@registered
def a6_corpus_statistics(spark, folder):
    stats = bm25.corpus_statistics(bm25.count_terms(_chunks(spark, folder)))
    return stats.withColumns({c: F.round(c, 6) for c in ("mean_length", "mean_idf")})


@registered
def a6_term_dictionary(spark, folder):
    return bm25.count_terms(_chunks(spark, folder)).dictionary().withColumn("idf", F.round("idf", 6))


# --- sources and sinks -----------------------------------------------------------


WORD_XML = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


@F.pandas_udf(T.BinaryType())
def _as_docx(text: pd.Series, lang: pd.Series, source: pd.Series) -> pd.Series:
    """A document per row: its lines as paragraphs, and a table with merged cells."""

    def paragraph(line: str) -> str:
        return f'<w:p><w:r><w:t xml:space="preserve">{escape(line)}</w:t></w:r></w:p>'

    def cell(line: str, merge: str = "") -> str:
        return f"<w:tc><w:tcPr>{merge}</w:tcPr>{paragraph(line)}</w:tc>"

    def packed(text: str, lang: str, source: str) -> bytes:
        wide = cell(lang, '<w:gridSpan w:val="2"/>') + cell(source, '<w:vMerge w:val="restart"/>')
        rows = f'<w:tr>{wide}</w:tr><w:tr>{cell("a")}{cell("b")}{cell("", "<w:vMerge/>")}</w:tr>'
        body = "".join(map(paragraph, text.split("\n"))) + f"<w:tbl>{rows}</w:tbl>"
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as archive:
            archive.writestr("word/document.xml", f'<w:document xmlns:w="{WORD_XML}"><w:body>{body}</w:body></w:document>')
        return out.getvalue()

    return pd.Series([packed(*row) for row in zip(text, lang, source)])


def _extracted(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files: some in a real docx, some of a declared type that is wrong."""
    lang = F.col("lang")
    kind = F.when(lang.isin("de", "es"), "docx").when(lang == "fr", "xls").otherwise("txt")
    packed = _as_docx(*[F.when(lang == "de", F.coalesce(c, F.lit(""))).otherwise("") for c in ("text", "lang", "source")])
    files = spread(table(spark, folder, "documents")).select(
        "doc_id", kind.alias("file_type"), F.when(lang == "de", packed).otherwise(F.encode("text", "UTF-8")).alias("content")
    )
    return landing.extract_text(files, error_col="problem")


@registered
def s13_extract_text(spark, folder):
    """Texts, and for the others why there is none."""
    problem = F.substring_index("problem", ":", 1)
    return _extracted(spark, folder).select("doc_id", "file_type", F.md5("raw_text").alias("text_md5"), problem.alias("problem"))


@registered
def s3_encode_events(spark, folder):
    return topics.encode_events(table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey"), "s_suppkey")


@registered
def s6_manifest_round_trip(spark, folder):
    path = scratch_path(spark, "manifest")
    manifest = _silver_like_events(spark, folder)
    topics.write_topic_files(topics.encode_events(manifest), path)
    back = topics.read_manifest(spark, path)
    return back.select("document_id", "file_name", "file_size_bytes", "category", "course_code", "uploaded_by")


def _silver_like_events(spark: SparkSession, folder: str) -> DataFrame:
    return _bronze(spark, folder).select(topics.MANIFEST_SCHEMA.names)


@registered
def s9_guarded_append(spark, folder):
    stored = StoredTable(spark, scratch_path(spark, "append"))
    half = table(spark, folder, "customer")
    stored.rebuild(half.filter("c_acctbal >= 0"))
    stored.append(half.filter("c_acctbal < 0"))
    return stored.read()


@registered
def s10_compaction(spark, folder):
    stored = StoredTable(spark, scratch_path(spark, "compact"), key="o_orderkey", buckets=8)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    stored.rebuild(orders.filter("o_orderstatus = 'O'"))
    stored.append(orders.filter("o_orderstatus <> 'O'"))
    stored.compact()
    return stored.read()


@registered
def s11_delete_where(spark, folder):
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    return mg.delete_where(docs.select("doc_id", "quality"), F.col("quality") == 0)


@registered
def s11_stored_delete(spark, folder):
    stored = StoredTable(spark, scratch_path(spark, "delete"), key="o_orderkey", buckets=8)
    stored.rebuild(table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"))
    stored.delete_where(F.col("o_orderpriority") == "1-URGENT")
    return stored.read()


@registered
def s12_vector_upsert(spark, folder):
    vectors = table(spark, folder, "embeddings").select(
        F.concat(F.lit("vec_"), F.col("vec_id").cast("string")).alias("chunk_id"),
        F.concat(F.lit("file_"), (F.col("label")).cast("string")).alias("file_name"),
        "embedding",
    )
    stored = retrieval.vector_table(spark, scratch_path(spark, "vectors"), buckets=8)
    retrieval.upsert_vectors(stored, vectors)
    # A new version of three files, with other vectors, stored twice.
    newer = vectors.filter(F.col("file_name").isin("file_1", "file_2", "file_3")).withColumn(
        "embedding", F.transform("embedding", lambda x: (-x).cast("float"))
    )
    retrieval.upsert_vectors(stored, newer)
    retrieval.upsert_vectors(stored, newer)
    parts = stored.read().select("chunk_id", "file_name", F.posexplode("embedding").alias("pos", "x"))
    return parts.withColumn("x", F.round(F.col("x").cast("double"), 6))


@registered
def s12_emptied_files(spark, folder):
    """Two files are embedded anew, of which one has become shorter and one empty."""
    vectors = table(spark, folder, "embeddings").select(
        F.concat(F.lit("vec_"), F.col("vec_id").cast("string")).alias("chunk_id"),
        F.concat(F.lit("file_"), F.col("label").cast("string")).alias("file_name"),
        "embedding",
    )
    stored = retrieval.vector_table(spark, scratch_path(spark, "vectors"), buckets=8)
    retrieval.upsert_vectors(stored, vectors)
    touched = vectors.filter(F.col("file_name").isin("file_1", "file_2"))
    shorter = touched.filter((F.col("file_name") == "file_1") & (F.get("embedding", F.lit(0)) > 0))
    retrieval.upsert_vectors(stored, shorter, files=touched.select("file_name").distinct())
    return stored.read().select("chunk_id", "file_name")


# --- projections and predicates -----------------------------------------------------


PART_KEYWORDS = [("ring", "round"), ("red", "coloured"), ("plate", "flat"), ("gear", "round"), ("blue", "coloured")]


@registered
def p1_first_keyword(spark, folder):
    part = table(spark, folder, "part")
    return part.select("p_partkey", tx.first_keyword(F.col("p_name"), PART_KEYWORDS, "other").alias("category"))


@registered
def p1_infer_category(spark, folder):
    """Names with one keyword, with two (the first in the list counts), and with none."""
    named = ["Graduation", "x_WITHDRAWAL", "scholarship_Attendance", "CS_Program_Scholarship", "cs_program", "notes"]
    part = F.get(F.array(*map(F.lit, named)), (F.col("document_id").cast("bigint") % len(named)).cast("int"))
    return _bronze(spark, folder).select("file_name", tx.infer_category(F.concat(part, F.lit("_"), "file_name")).alias("category"))


@registered
def p2_lookup_with_default(spark, folder):
    codes = {"ASIA": "as", "EUROPE": "eu"}
    return table(spark, folder, "region").select("r_name", tx.lookup(F.col("r_name"), codes, "xx").alias("code"))


@registered
def p3_suffix_and_stem(spark, folder):
    name = F.substring_index("url", "/", -1)
    return table(spark, folder, "pages").select(
        "page_id", tx.file_suffix(name).alias("suffix"), tx.file_stem(name).alias("stem")
    )


@registered
def p4_projection(spark, folder):
    return _bronze(spark, folder).select("document_id", "file_name", "file_type", "category", "file_size_bytes")


@registered
def p5_valid_rows(spark, folder):
    labels = table(spark, folder, "labels").withColumn("is_valid", F.col("quality") == 1)
    return layers.valid_rows(labels).select("doc_id", "toxic")


@registered
def p6_retrievable_rows(spark, folder):
    return layers.retrievable_rows(_silver(spark, folder)).select("file_name", F.length("clean_text").alias("n"))


@registered
def p7_marker_present(spark, folder):
    return _silver(spark, folder).select(
        "file_name", F.contains(F.coalesce("clean_text", F.lit("")), F.lit("on the")).alias("marked")
    )


@registered
def p8_silver_projection(spark, folder):
    return _silver(spark, folder).select(
        "file_name", "document_id", "file_type", "category", "uploaded_by", "upload_timestamp",
        F.md5("clean_text").alias("text_md5"), "word_count", "is_valid",
    )


@registered
def p9_chunk_metadata(spark, folder):
    return _chunks(spark, folder).select("chunk_id", "file_name", "category", "document_id")


# --- contract -------------------------------------------------------------------------


def _contract_events(spark: SparkSession, folder: str) -> DataFrame:
    """One upload event per document; languages and sources carry faults."""
    source, lang, doc = F.col("source"), F.col("lang"), F.col("doc_id").cast("string")
    suffix = F.when(lang == "fr", ".docx").when(lang == "de", ".pdf").when(lang == "es", ".md").otherwise(".TXT")
    event = F.struct(
        F.when(source == "src9", F.lit("not-a-uuid")).otherwise(F.md5(doc)).alias("document_id"),
        F.concat(F.when(source == "src14", "../").otherwise(" "), F.lit("doc_"), doc, suffix).alias("file_name"),
        F.concat(F.lit("/in/"), doc).alias("file_path"),
        F.when(lang == "fr", "docx").otherwise("txt").alias("file_type"),
        ((F.col("n_chars") - 500) * 5000).alias("file_size_bytes"),
        F.when(source == "src3", "misc").when(source != "src4", "policy").alias("category"),
        F.when(source != "src7", F.when(source == "src8", " \t").otherwise(source)).alias("uploaded_by"),
        F.when(source == "src11", "1700000000").when(source == "src12", "2024-01-01").when(source == "src13", "yesterday")
        .otherwise("2024-01-01T00:00:00.50+00:00").alias("upload_timestamp"),
        F.when(source == "src5", 1).alias("surprise"),
    )
    return spread(table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")).select(
        "doc_id", F.to_json(event).alias("value")
    )


def _labelled_paths(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "labels").select(F.concat(F.lit("/in/"), F.col("doc_id").cast("string")).alias("path"))


def _validated(spark: SparkSession, folder: str) -> DataFrame:
    return ct.validate(
        _contract_events(spark, folder), ct.DOCUMENT_CONTRACT, _labelled_paths(spark, folder), now=_clock()
    )


@registered
def v_contract_outcomes(spark, folder):
    return _validated(spark, folder).select("doc_id", "reason_code", "reason")


@registered
def v17_normalized_events(spark, folder):
    return ct.accepted(_validated(spark, folder))


@registered
def v18_rejected_events(spark, folder):
    bad = ct.rejected(_validated(spark, folder), now=_clock())
    return bad.select(
        F.get_json_object("original_event", "$.file_path").alias("file_path"), "rejection_reason", "reason_code"
    )


@registered
def s5_dead_letters(spark, folder):
    letters = topics.dead_letters(ct.rejected(_validated(spark, folder), now=_clock()))
    part = lambda path: F.get_json_object("value", path)
    return letters.select(
        part("$.original_event.file_path").alias("file_path"),
        part("$.rejection_reason").alias("rejection_reason"),
        part("$.rejected_at").alias("rejected_at"),
    )


@registered
def v_coercions(spark, folder):
    """Values of other types, blank and absent ones, and events that are no objects."""
    doc = F.col("doc_id").cast("string")
    whole = ["25", '"1_000"', "true", "12.0", "12.5", '"abc"', "[1]", '" +007 "', '"3.0"', "null"]
    texts = ['"Doc.TXT"', '" Doc.txt\\t"', '" \\t "', "7", "null"]
    types = ['"txt"', '"txt"', '"txt"', '"TXT"', '"xls"', "3", "null"]
    pick = lambda values, by: F.get(F.array(*map(F.lit, values)), (by % len(values)).cast("int"))
    value = F.concat(
        F.lit('{"file_name":'), pick(texts, F.col("n_chars")), F.lit(',"file_path":"/in//'), doc,
        F.lit('","file_type":'), pick(types, F.col("n_chars") + F.col("doc_id")),
        F.lit(',"file_size_bytes":'), pick(whole, F.col("doc_id")), F.lit(',"uploaded_by":" Bot "}'),
    )
    value = F.when(F.col("source") == "src1", F.concat(F.lit("["), value, F.lit("]"))).when(
        F.col("source") == "src2", F.substring(value, 1, F.length(value) - 1)
    ).otherwise(value)
    docs = spread(table(spark, folder, "documents").select("doc_id", "source", "n_chars"))
    paths = docs.select(F.concat(F.lit("/in/"), doc).alias("path"))
    out = ct.validate(docs.select("doc_id", value.alias("value")), ct.DOCUMENT_CONTRACT, paths, now=_clock())
    return out.select(
        "doc_id", "reason_code", "reason", F.col("event.file_name").alias("file_name"),
        F.col("event.file_size_bytes").alias("file_size_bytes"), F.col("event.uploaded_by").alias("uploaded_by"),
        F.col("event.category").alias("category"), F.col("event.upload_timestamp").alias("upload_timestamp"),
    )


@registered
def v_event_properties(spark, folder):
    """A second contract: the JSON properties of the event table."""
    props = ct.Contract(
        fields=(
            ct.Field(
                "k", "integer", required=True,
                checks=lambda v: [(v.try_cast("bigint") > 50, "too_large", F.format_string("k %s exceeds 50", v))],
            ),
        )
    )
    events = table(spark, folder, "events").select("event_id", "props")
    out = ct.validate(events, props, value_col="props")
    return out.select("event_id", "reason", F.col("event.k").alias("k"))


@registered
def a2_ingestion_counts(spark, folder):
    return ct.ingestion_counts(_validated(spark, folder))


@registered
def a3_rejection_breakdown(spark, folder):
    return ct.rejection_breakdown(_validated(spark, folder))


@registered
def h1_ingestion_gate(spark, folder):
    return ct.ingestion_verdict(_validated(spark, folder), min_accepted=answering.fixed.MIN_ACCEPTED)


@registered
def t3_stream_ingest(spark, folder):
    """The same events through the topic, the stream and the stored tables."""
    topic, root = scratch_path(spark, "topic"), scratch_path(spark, "ingestion")
    topics.write_topic_files(_contract_events(spark, folder), topic)
    ingest.run_ingestion(
        topics.stream_topic_files(spark, topic), root, inventory=_labelled_paths(spark, folder), now=_clock()
    )
    good = ingest.accepted_events(spark, root).agg(F.lit("accepted").alias("outcome"), F.count("*").alias("n"))
    bad = ingest.rejected_events(spark, root).groupBy(F.col("reason_code").alias("outcome")).agg(F.count("*").alias("n"))
    return good.unionByName(bad)


@registered
def t5_runs_go_on(spark, folder):
    """Three runs on one checkpoint, the second without new events, and a batch run again."""
    topic, root = scratch_path(spark, "topic"), scratch_path(spark, "ingestion")
    events, paths = _contract_events(spark, folder), ct.file_paths(_labelled_paths(spark, folder))
    stream = lambda: topics.stream_topic_files(spark, topic)
    run = lambda: ingest.run_ingestion(stream(), root, inventory=_labelled_paths(spark, folder), now=_clock())
    early = F.col("doc_id") % 2 == 0
    topics.write_topic_files(events.filter(early), topic)
    runs = [run(), run()]
    topics.write_topic_files(events.filter(~early), topic)
    runs.append(run())
    # As after a crash: the last batch comes again and replaces what it wrote.
    again = spark.read.parquet(f"{root}/{ingest.STAGED}/batch_id={runs[2][-1]}").select("value")
    ingest.ingest_batch(materialize(again, "again"), runs[2][-1], root, inventory=paths, now=_clock())
    stored = ingest.accepted_events(spark, root).select("batch_id", F.lit(1).alias("good")).unionByName(
        ingest.rejected_events(spark, root).select("batch_id", F.lit(0).alias("good"))
    )
    run_of = F.coalesce(*[F.when(F.col("batch_id").isin(ids), F.lit(n)) for n, ids in enumerate(runs, 1) if ids])
    return stored.groupBy(run_of.alias("run")).agg(
        F.count("*").alias("total"), F.sum("good").alias("accepted"), F.sum(1 - F.col("good")).alias("rejected")
    )


@registered
def t4_run_summary(spark, folder):
    """Every reason of a run with its count, and the totals beside each."""
    topic, root = scratch_path(spark, "topic"), scratch_path(spark, "ingestion")
    topics.write_topic_files(_contract_events(spark, folder), topic)
    batches = ingest.run_ingestion(
        topics.stream_topic_files(spark, topic), root, inventory=_labelled_paths(spark, folder), now=_clock()
    )
    summary = ingest.run_summary(spark, root, batches)
    totals = {name: F.lit(summary[name]).cast("bigint") for name in ("total", "accepted", "rejected")}
    return summary["rejection_reasons"].withColumns(totals)


@registered
def h3_gated_pipeline(spark, folder):
    """A gate that fails stops the steps after it; lineage tells the state and the rows of each."""
    house = lakehouse.Lakehouse(spark, scratch_path(spark, "house"))
    topics.write_topic_files(_contract_events(spark, folder), house.topic)
    try:
        with house.lineage.step("consume") as step:
            summary = lakehouse.consume(house, _labelled_paths(spark, folder))
            step.rows = summary["accepted"]
        with house.lineage.step("check") as step:
            step.rows = summary["rejected"]
            lakehouse.check_ingestion(summary, min_accepted=summary["total"] + 1)
        with house.lineage.step("bronze"):
            lakehouse.load_bronze(house)
    except lakehouse.PipelineHalted:
        pass
    rows = house.lineage.read().groupBy("run_id").agg(F.max("row_count").alias("row_count"))
    states = lineage.lineage_summary(house.lineage.read()).join(rows, "run_id")
    return states.select("job", "state", "failures", "completions", "row_count")


# --- merges -------------------------------------------------------------------------------


def _merge_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers as the target, quantities per part as the incoming rows."""
    target = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("amount"))
    source = table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg(F.sum("l_quantity").alias("amount"))
    return target, source


@registered
def m1_merge_insert_only(spark, folder):
    return mg.merge_insert_only(*_merge_sides(spark, folder), "id")


@registered
def m2_merge_upsert(spark, folder):
    return mg.merge_upsert(*_merge_sides(spark, folder), "id")


@registered
def m2_stored_merge(spark, folder):
    target, source = _merge_sides(spark, folder)
    stored = StoredTable(spark, scratch_path(spark, "merge"), key="id", buckets=8)
    stored.merge(target, update_existing=False)
    stored.merge(source, update_existing=True)
    stored.merge(source.withColumn("amount", F.lit(-1.0)), update_existing=False)
    return stored.read()


@registered
def m4_unchanged_rows(spark, folder):
    """All orders come again, urgent ones with another priority, and some that are new: what a stored merge counts."""
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), "o_orderpriority", "o_totalprice", "o_orderdate")
    stored = StoredTable(spark, scratch_path(spark, "orders"), key="id", buckets=8)
    stored.rebuild(orders.filter("o_orderpriority <> '5-LOW'"))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    counts = stored.merge(orders.withColumn("o_orderpriority", F.when(urgent, "0-NOW").otherwise(F.col("o_orderpriority"))), True)
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} bigint" for name in counts))


@registered
def m4_merge_metrics(spark, folder):
    return mg.merge_metrics(*_merge_sides(spark, folder), "id", update_existing=True)


@registered
def w2_latest_per_key(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    order = [F.desc("l_shipdate"), F.desc("l_orderkey"), F.desc("l_linenumber")]
    return mg.latest_per_key(lines, "l_partkey", order).drop("l_shipdate")


@registered
def u1_latest_revision(spark, folder):
    """Every source re-uploads the same few file names many times."""
    uploads = table(spark, folder, "documents").select(
        F.concat("source", F.lit("_"), "lang", F.lit(".txt")).alias("file_name"),
        F.format_string("%08d", "doc_id").alias("document_id"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("n_chars").cast("int")), "yyyy-MM-dd'T00:00:00Z'")
        .alias("upload_timestamp"),
    )
    return mg.latest_revision(uploads)


@registered
def u1_stored_revision(spark, folder):
    """The same uploads with their texts, read from a stored table: texts are not shuffled."""
    uploads = table(spark, folder, "documents").select(
        F.concat("source", F.lit("_"), "lang", F.lit(".txt")).alias("file_name"),
        F.format_string("%08d", "doc_id").alias("document_id"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("n_chars").cast("int")), "yyyy-MM-dd'T00:00:00Z'")
        .alias("upload_timestamp"),
        F.col("text").alias("raw_text"),
    )
    stored = StoredTable(spark, scratch_path(spark, "uploads"))
    stored.rebuild(uploads)
    latest = mg.latest_stored_revision(stored.read())
    return latest.select("file_name", "document_id", "upload_timestamp", F.md5("raw_text").alias("text_md5"))


@registered
def u3_revise_once(spark, folder):
    """Addenda for labelled documents, skipped where the marker is there."""
    revisions = table(spark, folder, "labels").select(
        file_name_of(F.col("doc_id")).alias("file_name"),
        F.lit("on the").alias("marker"),
        F.concat(F.lit("\n\nADDENDUM: toxic "), F.col("toxic").cast("string")).alias("addendum"),
        F.concat(F.lit("rev-"), F.col("doc_id").cast("string")).alias("document_id"),
    )
    revised = layers.refresh_text_columns(mg.revise(_silver(spark, folder), "file_name", revisions))
    return revised.select("file_name", "document_id", F.md5("clean_text").alias("text_md5"), "word_count")


@registered
def u2_all_addenda(spark, folder):
    """Three addenda for each labelled document in one batch, one of them repeated."""
    labelled = table(spark, folder, "labels").crossJoin(F.broadcast(spark.range(3).withColumn("n", F.array(F.lit(2), F.lit(1), F.lit(2))[F.col("id").cast("int")])))
    revisions = labelled.select(
        file_name_of(F.col("doc_id")).alias("file_name"),
        F.concat(F.lit("ADDENDUM "), F.col("n").cast("string")).alias("marker"),
        F.concat(F.lit("\n\nADDENDUM "), F.col("n").cast("string"), F.lit(": quality "), F.col("quality").cast("string")).alias("addendum"),
        F.concat(F.lit("rev-"), F.col("n").cast("string")).alias("document_id"),
    )
    revised = layers.refresh_text_columns(mg.revise(_silver(spark, folder), "file_name", revisions))
    return revised.select("file_name", "document_id", F.md5("clean_text").alias("text_md5"), "word_count")


@registered
def j1_existing_files(spark, folder):
    docs = _bronze(spark, folder).select("file_name", "file_path")
    known = _labelled_paths(spark, folder).withColumnRenamed("path", "file_path")
    return docs.join(known, "file_path", "left_semi")


@registered
def e1_union_events(spark, folder):
    full = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    short = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"))
    return mg.union_events(full, short)


@registered
def o1_ordered_documents(spark, folder):
    return _bronze(spark, folder).select("category", "file_name").orderBy("category", "file_name")


@registered
def o3_topk_per_group(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")]
    return topk.rank_per_query(lines, 6, order, query_id="l_suppkey")


# --- text ------------------------------------------------------------------------------------


def _untidy(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with blanks, tabs and empty lines put in."""
    spaced = F.replace(F.replace("text", F.lit(" "), F.lit(" \t ")), F.lit("\n"), F.lit("\n\n\n\n"))
    return spread(table(spark, folder, "documents")).select("doc_id", F.concat(F.lit("\n\t "), spaced, F.lit(" \r\n")).alias("text"))


@registered
def x1_nfkc(spark, folder):
    """Texts with compatibility characters put in, which the normal form takes out again."""
    docs = spread(table(spark, folder, "documents"))
    wide = F.translate(F.replace("text", F.lit("fi"), F.lit("\ufb01")), "mnu .2", "\uff4d\uff4e\uff55\u00a0\uff0e\u00b2")
    return docs.select("doc_id", (wide != F.col("text")).alias("changed"), F.md5(tx.nfkc(wide)).alias("text_md5"))


@registered
def x2_clean_text(spark, folder):
    return _untidy(spark, folder).select("doc_id", F.md5(tx.clean(F.col("text"))).alias("text_md5"))


@registered
def x6_word_count(spark, folder):
    return _untidy(spark, folder).select("doc_id", tx.word_count(F.col("text")).alias("word_count"))


@registered
def x8_sentences(spark, folder):
    found = tx.sentences(F.col("text"))
    return _untidy(spark, folder).select(
        "doc_id", F.size(found).alias("n"), F.md5(F.array_join(found, "|")).alias("sentences_md5")
    )


@registered
def x9_chunks(spark, folder):
    return _chunks(spark, folder).select("chunk_id", F.md5("text").alias("text_md5"), "category")


@registered
def x11_tokens(spark, folder):
    found = tx.tokens(F.col("text"))
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", F.size(found).alias("n"), F.md5(F.array_join(found, " ")).alias("tokens_md5")
    )


@registered
def x12_reason_key(spark, folder):
    """Messages cut at a bracket, at a dash, at whichever comes first, and not at all."""
    kinds = [
        F.concat("c_name", F.lit(" (balance "), "c_mktsegment", F.lit(" — low)")),
        F.concat("c_name", F.lit(" — "), "c_mktsegment", F.lit(" (low)")),
        F.concat("c_name", F.lit("-"), "c_mktsegment", F.lit("(low)")),
    ]
    message = F.get(F.array(*kinds), (F.col("c_custkey") % len(kinds)).cast("int"))
    return table(spark, folder, "customer").select("c_custkey", tx.reason_key(message).alias("reason_key"))


@registered
def x13_record_name(spark, folder):
    identity = F.when(F.col("lang") != "fr", F.col("doc_id").cast("string"))
    name = F.when(F.col("lang") != "de", F.concat("source", F.lit(" of "), "lang", F.lit(".v1.txt")))
    return table(spark, folder, "documents").select("doc_id", tx.record_name(identity, name).alias("record_name"))


@registered
def x14_iso_time(spark, folder):
    return table(spark, folder, "events").select("event_id", tx.iso_utc(F.col("ts").cast("timestamp")).alias("iso"))


@registered
def x16_json_properties(spark, folder):
    parsed = F.try_parse_json("props")
    return table(spark, folder, "events").select("event_id", F.try_variant_get(parsed, "$.k", "bigint").alias("k"))


@registered
def x17_refusal_wording(spark, folder):
    """The refusal within a text, in capitals or not, and a part of it only."""
    refusal = F.lit(answering.fixed.REFUSAL_TEXT)
    text = (
        F.when(F.contains("text", F.lit("me")), F.concat("text", F.upper(refusal), "text"))
        .when(F.contains("text", F.lit("on")), F.concat("text", F.substring(refusal, 1, len(answering.fixed.REFUSAL_TEXT) - 1)))
        .otherwise(F.col("text"))
    )
    return table(spark, folder, "conversations").select("conv_id", "turn", answering.is_refusal(text).alias("refused"))


# --- quality, gates, lineage ---------------------------------------------------------------------


@registered
def q_silver_suite(spark, folder):
    return ex.check_expectations(_silver_measures(spark, folder), ex.SILVER_SUITE)


@registered
def q_lineitem_suite(spark, folder):
    suite = [
        ex.not_null("l_orderkey"),
        ex.matches("l_returnflag", "^[AN]$"),
        ex.between("l_discount", 0.0, 0.08),
        ex.between("l_quantity", min_value=1),
        ex.in_set("l_linestatus", ["O"]),
        ex.unique("l_orderkey"),
        ex.unique("l_shipdate"),
    ]
    return ex.check_expectations(table(spark, folder, "lineitem"), suite)


@registered
def q_nullable_columns(spark, folder):
    labelled = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    suite = [ex.not_null("quality"), ex.between("quality", min_value=1), ex.in_set("toxic", [0]), ex.unique("doc_id")]
    return ex.check_expectations(labelled, suite)


@registered
def h2_quality_verdict(spark, folder):
    return ex.suite_verdict(ex.check_expectations(_silver_measures(spark, folder), ex.SILVER_SUITE))


@registered
def g1_refused_writes(spark, folder):
    """Appends that do not fit the declared columns: why each is refused, and the rows that stay."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    declared = T.StructType(
        [T.StructField(f.name, f.dataType, f.name == "c_acctbal") for f in customers.schema]
    )
    stored = StoredTable(spark, scratch_path(spark, "guarded"), declared)
    stored.rebuild(customers)
    attempts = {
        "extra column": customers.withColumn("note", F.lit("n")),
        "missing column": customers.drop("c_name"),
        "other type": customers.withColumn("c_acctbal", F.col("c_acctbal").cast("string")),
        "null": customers.withColumn("c_name", F.when(F.col("c_custkey") > 1, F.col("c_name"))),
        "nullable": customers.withColumn("c_acctbal", F.when(F.col("c_custkey") > 1, F.col("c_acctbal"))),
    }
    outcomes = []
    for attempt, rows in attempts.items():
        try:
            stored.append(rows)
            outcomes.append((attempt, None, stored.count()))
        except schema_guard.SchemaViolation as refusal:
            outcomes.append((attempt, str(refusal), stored.count()))
        except Exception as failure:
            found = re.search("NULL in not-null column [a-z_]+", str(failure))
            if found is None:
                raise
            outcomes.append((attempt, found.group(0), stored.count()))
    return spark.createDataFrame(outcomes, "attempt string, problem string, rows_after bigint")


@registered
def g2_null_violations(spark, folder):
    bronze = _extracted(spark, folder).join(table(spark, folder, "labels"), "doc_id", "left")
    declared = T.StructType(
        [T.StructField(n, bronze.schema[n].dataType, False) for n in ("doc_id", "raw_text", "quality")]
    )
    return schema_guard.null_violations(bronze, declared)


@registered
def l2_lineage_summary(spark, folder):
    out = lineage.lineage_summary(
        table(spark, folder, "events"), ["user_id"], "event_type", "ts", start="signup", complete="purchase", fail="error"
    )
    return out.select("user_id", "state", "failures", "completions", F.round("duration_seconds", 6).alias("duration_seconds"))


# --- retrieval --------------------------------------------------------------------------------------


@registered
def d1_embeddings(spark, folder):
    slots = dense.embed(_items(spark, folder)).select("query_id", F.posexplode("embedding").alias("slot", "weight"))
    return slots.filter("weight <> 0").withColumn("weight", F.round(F.col("weight").cast("double"), 5))


def _label_centres(spark: SparkSession, folder: str) -> DataFrame:
    """One query vector per label: the mean of its vectors."""
    parts = table(spark, folder, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = parts.groupBy("label", "pos").agg(F.avg("x").alias("x"))
    return means.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"]).alias("embedding")
    )


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding")


@registered
def d2_dense_topk(spark, folder):
    hits = dense.dense_topk(_vectors(spark, folder), _label_centres(spark, folder), 6)
    return hits.withColumn("distance", F.round("distance", 6))


@registered
def d3_approx_topk(spark, folder):
    vectors = _vectors(spark, folder)
    centres = dense.fit_cells(vectors, 16)
    hits = dense.approx_dense_topk(
        dense.assign_cells(vectors, centres), _label_centres(spark, folder), centres, n_probe=8, k=6
    )
    return hits.withColumn("distance", F.round("distance", 6))


def _every_fiftieth(vectors: DataFrame) -> DataFrame:
    """The fixed query set of searches by vector."""
    return vectors.filter(F.col("chunk_id") % 50 == 0).select(F.col("chunk_id").alias("query_id"), "embedding")


def _recall_row(exact: DataFrame, approx: DataFrame) -> DataFrame:
    """How many hits there are, and whether nine tenths are found."""
    return dense.recall(exact, approx).select("expected", (F.col("recall") >= 0.9).alias("nine_tenths_found"))


@registered
def d3_approx_recall(spark, folder):
    """Nine of 16 cells probed, against exact search."""
    vectors = _vectors(spark, folder)
    queries = _every_fiftieth(vectors)
    centres = dense.fit_cells(vectors, 16)
    approx = dense.approx_dense_topk(dense.assign_cells(vectors, centres), queries, centres, n_probe=9, k=6)
    return _recall_row(dense.dense_topk(vectors, queries, 6), approx)


@registered
def d3_compressed_recall(spark, folder):
    """Vectors of 64 numbers as 16 bytes, ten candidates for each hit, against exact search."""
    vectors = _vectors(spark, folder)
    queries = _every_fiftieth(vectors)
    centres, codebooks = dense.fit_cells(vectors, 16), dense.fit_codebooks(vectors, 16)
    coded = dense.compress(dense.assign_cells(vectors, centres), codebooks).select("chunk_id", "code", "cell")
    codes = dense.store_cells(coded, scratch_path(spark, "codes"))
    approx = dense.compressed_topk(vectors, codes, queries, centres, codebooks, n_probe=9, k=6, candidates=60)
    return _recall_row(dense.dense_topk(vectors, queries, 6), approx)


@registered
def d3_compressed_all_cells(spark, folder):
    """All cells probed and as many candidates as rows: the exact result, by way of the codes."""
    vectors = _vectors(spark, folder)
    centres, codebooks = dense.fit_cells(vectors, 4), dense.fit_codebooks(vectors, 16)
    codes = dense.compress(dense.assign_cells(vectors, centres), codebooks).select("chunk_id", "code", "cell")
    n = vectors.count()
    hits = dense.compressed_topk(vectors, codes, _every_fiftieth(vectors), centres, codebooks, n_probe=4, k=6, candidates=n)
    return hits.withColumn("distance", F.round("distance", 6))


@registered
def d2_vector_queries(spark, folder):
    hits = dense.dense_topk(_vectors(spark, folder), _every_fiftieth(_vectors(spark, folder)), 6)
    return hits.withColumn("distance", F.round("distance", 6))


@registered
def d3_approx_given_cells(spark, folder):
    """Labels' means as cells and as queries; each query probes the two cells next to it."""
    queries = materialize(_label_centres(spark, folder), "centres")
    given = queries.orderBy("query_id").toPandas()  # one row for each label
    centres = np.stack(given["embedding"].to_list()).astype(float)
    cells = dense.store_cells(dense.assign_cells(_vectors(spark, folder), centres), scratch_path(spark, "cells"))
    hits = dense.approx_dense_topk(cells, queries, centres, n_probe=2, k=20)
    return hits.withColumn("distance", F.round("distance", 6))


@registered
def d4_bm25_topk(spark, folder):
    hits = bm25.bm25_topk(bm25.build_index(_chunks(spark, folder)), _items(spark, folder), 6)
    return hits.withColumn("score", F.round("score", 6))


@registered
def d4_bm25_user_turns(spark, folder):
    hits = bm25.bm25_topk(bm25.build_index(_chunks(spark, folder)), _user_turns(spark, folder), 10)
    return hits.withColumn("score", F.round("score", 6))


@registered
def d4a_bm25_padded(spark, folder):
    """Region names as queries: few chunks hold one, so most hits are padding."""
    queries = table(spark, folder, "region").select(F.col("r_regionkey").alias("query_id"), F.col("r_name").alias("text"))
    hits = bm25.bm25_topk(bm25.build_index(_chunks(spark, folder)), queries, 6, pad_to_k=True)
    return hits.withColumn("score", F.round("score", 6))


@registered
def d4_bm25_postings(spark, folder):
    """The same queries without padding, answered from stored postings."""
    queries = table(spark, folder, "region").select(F.col("r_regionkey").alias("query_id"), F.col("r_name").alias("text"))
    index = bm25.store_postings(bm25.build_index(_chunks(spark, folder)), scratch_path(spark, "postings"), buckets=8)
    return bm25.bm25_topk(index, queries, 6).withColumn("score", F.round("score", 6))


@registered
def d5_rank_fusion(spark, folder):
    """Two rankings of the suppliers of each part, fused."""
    lines = topk.dealt(table(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_quantity"), "l_partkey").groupBy(
        F.col("l_partkey").alias("query_id"), F.col("l_suppkey").alias("chunk_id")
    ).agg(F.sum("l_quantity").alias("q"), F.min("l_quantity").alias("m"))
    first = topk.rank_per_query(lines, 6, [F.desc("q"), F.asc("chunk_id")])
    second = topk.rank_per_query(lines, 6, [F.asc("m"), F.asc("chunk_id")])
    return ranking.reciprocal_rank_fusion(first, second).withColumn("rrf_score", F.round("rrf_score", 9))


@registered
def d6_hybrid_search(spark, folder):
    hits = retrieval.hybrid_search(_search_index(spark, folder), _items(spark, folder))
    return hits.withColumn("rrf_score", F.round("rrf_score", 9))


@registered
def d6_hybrid_all_cells(spark, folder):
    """The dense list from a table of cells, all of which are probed: the exact result."""
    index = retrieval.build_search_index(_chunks(spark, folder), n_cells=16)
    hits = retrieval.hybrid_search(index, _items(spark, folder), n_probe=16)
    return hits.withColumn("rrf_score", F.round("rrf_score", 9))


@registered
def d6_refreshed_index(spark, folder):
    """A stored index, refreshed: English documents get another text, French ones are emptied, German ones come in."""
    silver = materialize(_silver(spark, folder), "silver", compression="zstd")
    changed = F.when(F.col("category") == "en", F.concat(F.lit("An earlier wording. "), "clean_text")).otherwise(F.col("clean_text"))
    store = search_store.SearchStore(spark, scratch_path(spark, "search"), buckets=8)
    earlier = silver.filter("category <> 'de'").withColumn("clean_text", changed)
    store.build(chunk_documents(layers.retrievable_rows(earlier)))
    later = silver.withColumn("clean_text", F.when(F.col("category") == "fr", "").otherwise(F.col("clean_text")))
    later = layers.refresh_text_columns(later.filter(F.col("category").isin("en", "fr", "de")))
    store.refresh(chunk_documents(layers.retrievable_rows(later)), later)
    # Once more, which changes nothing.
    store.refresh(chunk_documents(layers.retrievable_rows(later)), later)
    hits = retrieval.hybrid_search(store.open(), _items(spark, folder))
    return hits.withColumn("rrf_score", F.round("rrf_score", 9))


@registered
def d7_rerank(spark, folder):
    index, queries = _search_index(spark, folder), _items(spark, folder)
    reranked = retrieval.search_and_rerank(index, queries, retrieval.hybrid_search(index, queries))
    return reranked.select("query_id", "chunk_id", "rank", "candidate_rank", "rerank_score")


@registered
def d8_context(spark, folder):
    index, queries = _search_index(spark, folder), _items(spark, folder)
    reranked = retrieval.search_and_rerank(index, queries, retrieval.hybrid_search(index, queries))
    return answering.build_context(reranked).select(
        "query_id", F.md5("context").alias("context_md5"), F.array_join("citations", "|").alias("citations")
    )


@registered
def d8_messages(spark, folder):
    messages = answering.build_messages(F.col("text"), F.col("text"))
    return _items(spark, folder).select("query_id", F.inline(messages)).select(
        "query_id", "role", F.md5("content").alias("content_md5")
    )


def _echo_generator():
    """A stand-in model: repeats the question."""
    return lambda messages: ["Re: " + m[1]["content"].split("QUESTION: ")[-1] for m in messages]


@registered
def d9_generated_answers(spark, folder):
    """A plugged generator; regions have no context, so it never sees them."""
    items = _items(spark, folder)
    regions = table(spark, folder, "region").select((-1 - F.col("r_regionkey")).cast("bigint").alias("query_id"), F.col("r_name").alias("text"))
    ranked = items.select(
        "query_id", F.lit(1).alias("rank"), F.lit("c").alias("chunk_id"), F.lit("f.txt").alias("file_name"), "text"
    )
    answers = answering.generate_answers(items.unionByName(regions), answering.build_context(ranked), _echo_generator)
    return answers.select("query_id", "answer", F.array_join("citations", "|").alias("citations"))


@registered
def d10_answers(spark, folder):
    answers = retrieval.answer_queries(_search_index(spark, folder), _items(spark, folder))
    return answers.select(
        "query_id", "query", "answer", F.array_join("citations", "|").alias("citations"),
        F.size("context_used").alias("chunks_used"), "hybrid_candidate_count",
    )
