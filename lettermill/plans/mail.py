"""Queries of the cleaner, the thread grouper and the bulk filter over the mail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.config import DEFAULT
from lettermill.operators import bulk, clean, dedup, lines, meta, similarity, threads
from lettermill.operators.html import readable
from lettermill.session import Scratch, table


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "armis_raw_email").select("row_idx", "eid", "raw_body")


def _mails(spark: SparkSession, d: str) -> DataFrame:
    return dedup.keep_first(table(spark, d, "thread_grouper"))


# ---------------------------------------------------------------- records


def dedup_keep_first(spark: SparkSession, d: str) -> DataFrame:
    return dedup.keep_first(_raw(spark, d)).select("eid", "row_idx")


def dedup_keep_last(spark: SparkSession, d: str) -> DataFrame:
    return dedup.keep_first(_raw(spark, d), last=True).select("eid", "row_idx")


def dedup_stats(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_stats(_raw(spark, d))


def point_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Clean text of one mail by its id (here the smallest): the id is compared in the scan, before anything is cleaned."""
    raw = _raw(spark, d)
    wanted = raw.agg(F.min("eid")).first()[0]
    one = dedup.keep_first(raw.where(F.col("eid") == F.lit(wanted)), last=True)
    return clean.clean_bodies(one, truncate=None).select("eid", "body_text")


def first_sample(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw(spark, d).orderBy("row_idx").limit(5)
    short = F.when(F.length("eid") > 55, F.concat(F.substring("eid", 1, 55), F.lit("..."))).otherwise(F.col("eid"))
    return raw.select("row_idx", short.alias("short_id"), F.length("raw_body").cast("long").alias("n"))


# ---------------------------------------------------------------- line operators


def _on_lines(op, join: bool = True):  # noqa: ANN001, ANN202
    def run(spark: SparkSession, d: str) -> DataFrame:
        raw = _raw(spark, d).where("raw_body is not null").withColumn("ls", lines.split_lines(F.col("raw_body")))
        return raw.select("row_idx", lines.join_lines(op(F.col("ls"))).alias("text"))

    return run


reply_chain_cut = _on_lines(lines.cut_reply_chain)
disclaimer_removal = _on_lines(lines.drop_disclaimers)
signature_removal = _on_lines(lambda x: lines.drop_signatures(x, keep_history=True))
signature_removal_truncate = _on_lines(lambda x: lines.drop_signatures(x, keep_history=False))
line_noise = _on_lines(lines.drop_noise)
quote_strip = _on_lines(lines.strip_quotes)
inline_signatures = _on_lines(lines.drop_inline_signatures)


def blank_collapse(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).where("raw_body is not null").select("row_idx", lines.collapse_blanks(F.col("raw_body")).alias("text"))


def link_cleanup(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).where("raw_body is not null").select("row_idx", clean.clean_links(F.col("raw_body")).alias("text"))


def html_sniff(spark: SparkSession, d: str) -> DataFrame:
    from lettermill import rx

    return _raw(spark, d).select("row_idx", F.coalesce(lines.has(F.col("raw_body"), rx.HTML), F.lit(False)).alias("is_html"))


def header_lines(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw(spark, d).where("raw_body is not null").select("row_idx", F.posexplode(lines.split_lines(F.col("raw_body"))).alias("pos", "line"))
    return raw.where(lines.is_header(F.col("line"))).select("row_idx", "pos")


def header_blocks(spark: SparkSession, d: str) -> DataFrame:
    """First lines of header blocks, blank lines between headers filled."""
    raw = _raw(spark, d).where("raw_body is not null").select("row_idx", lines.header_flags(lines.split_lines(F.col("raw_body"))).alias("f"))
    starts = F.filter(F.transform("f", lambda x, i: F.when(x & ~((i > 0) & F.coalesce(F.get("f", i - 1), F.lit(False))), i)), lambda x: x.isNotNull())
    return raw.select("row_idx", F.explode(starts).alias("pos"))


def header_block_metadata(spark: SparkSession, d: str) -> DataFrame:
    return meta.header_block_metadata(_raw(spark, d), "row_idx", "raw_body")


def header_lines_dropped(spark: SparkSession, d: str) -> DataFrame:
    return _on_lines(lines.drop_header_lines)(spark, d)


def stitched_headers(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).where("raw_body is not null").select("row_idx", clean.stitch_headers(F.col("raw_body")).alias("text"))


def finished_text(spark: SparkSession, d: str) -> DataFrame:
    """The last layer: blanks, outer quotes, shortest length."""
    return _raw(spark, d).where("raw_body is not null").select("row_idx", clean.finish(F.col("raw_body")).alias("text"))


def layers_truncate(spark: SparkSession, d: str) -> DataFrame:
    """All layers after rendering, latest reply only."""
    m = table(spark, d, "thread_grouper").where("body_text is not null")
    return m.select("row_idx", clean.clean_text(F.col("body_text"), keep_history=False).alias("text"))


def first_address(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).select("row_idx", meta.first_address(F.col("raw_body")).alias("address"))


def field_counts(spark: SparkSession, d: str) -> DataFrame:
    return meta.field_counts(table(spark, d, "thread_grouper"))


def extract_timestamp(spark: SparkSession, d: str) -> DataFrame:
    """The instant of each mail's own date text, in the metadata."""
    return meta.with_metadata(_raw(spark, d)).select("row_idx", "date", "timestamp", "participants_str")


def signature_parts(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw(spark, d).where("raw_body is not null").select("row_idx", F.posexplode(lines.split_lines(F.col("raw_body"))).alias("pos", "line"))
    return raw.where(lines.is_signature_part(F.col("line"))).select("row_idx", "pos")


def corpus_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("source is not null").select("source", meta.corpus_title(F.col("source")).alias("title")).distinct()


def line_classes(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw(spark, d).where("raw_body is not null").select("row_idx", F.posexplode(lines.split_lines(F.col("raw_body"))).alias("pos", "line"))
    return raw.select("row_idx", "pos", lines.line_class(F.col("line")).alias("class"))


# ---------------------------------------------------------------- cleaner


def clean_body_keep(spark: SparkSession, d: str) -> DataFrame:
    return clean.clean_bodies(_raw(spark, d), truncate=None).select("row_idx", "body_text")


def clean_body_truncate(spark: SparkSession, d: str) -> DataFrame:
    return clean.clean_bodies(_raw(spark, d), keep=None).select("row_idx", "cleaned_body")


def html_to_text(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).select("row_idx", readable(F.col("raw_body"), True).alias("text"))


def clean_length_stats(spark: SparkSession, d: str) -> DataFrame:
    n = F.length("cleaned_body")
    mails = table(spark, d, "thread_grouper").select("cleaned_body").where(n > 0)
    return mails.agg(F.count(F.lit(1)).alias("non_empty"), F.avg(n).cast("long").alias("mean_n"), F.min(n).cast("long").alias("min_n"), F.max(n).cast("long").alias("max_n"))


def body_length_counts(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "thread_grouper")
    over = lambda c: F.coalesce(F.length(c), F.lit(0)) > 10
    return m.agg(
        F.count_if(over("body_text")).alias("full_over_10"), F.count_if(over("cleaned_body")).alias("clean_over_10"),
        F.round(F.avg(F.when(over("body_text"), F.length("body_text"))), 6).alias("mean_full"),
        F.count_if(F.coalesce(F.col("from_addr"), F.lit("")) != "").alias("with_sender"), F.count_if(F.coalesce(F.col("subject"), F.lit("")) != "").alias("with_subject"),
    )


# ---------------------------------------------------------------- metadata


def _meta(c: str, out: str):  # noqa: ANN202
    def run(spark: SparkSession, d: str) -> DataFrame:
        r = F.coalesce(F.col("raw_body"), F.lit(""))
        value = {
            "sender": meta.sender, "recipients": lambda x: meta.addresses_of(x, "To"), "cc": lambda x: meta.addresses_of(x, "Cc"),
            "addresses": lambda x: F.array_join(meta.all_addresses(x), "; "), "subject": meta.subject, "date": meta.date_text, "depth": meta.reply_depth,
        }[c](r)
        return _raw(spark, d).select("row_idx", value.alias(out))

    return run


extract_sender, extract_recipients, extract_cc = _meta("sender", "from_addr"), _meta("recipients", "to_addr"), _meta("cc", "cc_addr")
extract_addresses, extract_subject, extract_date, reply_depth = _meta("addresses", "addresses"), _meta("subject", "subject"), _meta("date", "date"), _meta("depth", "reply_depth")


# ---------------------------------------------------------------- similarity and threads


def token_sets(spark: SparkSession, d: str) -> DataFrame:
    t = F.array_sort(similarity.tokens(F.col("body_text")))
    return table(spark, d, "thread_grouper").select("row_idx", F.size(t).cast("long").alias("n"), F.array_join(t, " ").alias("tokens"))


def token_doc_freq(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "thread_grouper").select(F.explode(similarity.tokens(F.col("body_text"))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("df"))


def jaccard_pairs(spark: SparkSession, d: str) -> DataFrame:
    p = similarity.jaccard_join(_mails(spark, d), "row_idx", "body_text", below=DEFAULT.near_identical)
    return similarity.edges_between(p).select("i", "j", F.round("sim", 6).alias("sim"))


def jaccard_near_identical(spark: SparkSession, d: str) -> DataFrame:
    p = similarity.jaccard_join(_mails(spark, d), "row_idx", "body_text", threshold=DEFAULT.near_identical)
    return p.select("i", "j", F.round("sim", 6).alias("sim"))


def tfidf_weights(spark: SparkSession, d: str) -> DataFrame:
    return similarity.tfidf(_mails(spark, d), "row_idx", "body_text").select("k", "term", F.round("w", 6).alias("w"))


def tfidf_bulk_terms(spark: SparkSession, d: str) -> DataFrame:
    w = similarity.tfidf(_mails(spark, d), "row_idx", "cleaned_body", vocabulary=DEFAULT.bulk_vocabulary, min_df=2, sublinear=True)
    return w.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.round(F.sum("w"), 4).alias("w"))


def cosine_pairs(spark: SparkSession, d: str) -> DataFrame:
    p = similarity.cosine_texts(*similarity.term_rows(_mails(spark, d), "row_idx", "body_text", Scratch(spark, "cosine")))
    return p.select("i", "j", F.round("sim", 6).alias("sim"))


def message_id_links(spark: SparkSession, d: str) -> DataFrame:
    """Links by ids in bodies: each mail's body with a reply field for every mail that the edge table says it answers."""
    rows = _raw(spark, d).where("eid is not null and raw_body is not null")
    by = table(spark, d, "thread_grouper").select("row_idx", "eid")
    e = table(spark, d, "edges").where("match_method = 'message_id' and i <> j").select("i", "j").distinct()
    said = e.join(by.select(F.col("row_idx").alias("i"), F.col("eid").alias("eid")), "i").join(by.select(F.col("row_idx").alias("j"), F.col("eid").alias("other")), "j")
    said = said.where("eid <> other").groupBy("eid").agg(F.array_join(F.array_sort(F.collect_set(F.concat(F.lit("\nIn-Reply-To: "), F.col("other")))), "").alias("fields"))
    full = dedup.keep_first(rows).join(said, "eid", "left").withColumn("raw_body", F.concat("raw_body", F.coalesce("fields", F.lit(""))))
    return threads.id_links(full)


def _edges(spark: SparkSession, d: str) -> DataFrame:
    """Links of the edge table between existing rows that may merge mails."""
    e = table(spark, d, "edges").where("i is not null and j is not null and i <> j")
    ok = (F.col("match_method") == "message_id") | ((F.col("sim") >= DEFAULT.jaccard_threshold) & (F.col("sim") < DEFAULT.near_identical) & ~F.isnan("sim"))
    rows = table(spark, d, "thread_grouper").select(F.col("row_idx").alias("i"))
    e = e.where(ok).join(rows, "i", "left_semi").join(rows.withColumnRenamed("i", "j"), "j", "left_semi")
    return e.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).distinct()


def _threaded(spark: SparkSession, d: str) -> DataFrame:
    """``row_idx, eid, thread_id`` by the links of the edge table; narrow."""
    rows = table(spark, d, "thread_grouper").select("row_idx", "eid", "body_text")
    comps = threads.clusters(rows, _edges(spark, d))
    return Scratch(spark, "threaded").cut(threads.thread_ids(rows.select("row_idx", "eid"), comps))


def thread_components(spark: SparkSession, d: str) -> DataFrame:
    from lettermill.operators.components import connected_components

    return connected_components(_edges(spark, d))


def thread_duplicate_split(spark: SparkSession, d: str) -> DataFrame:
    return threads.clusters(table(spark, d, "thread_grouper"), _edges(spark, d))


def thread_ids(spark: SparkSession, d: str) -> DataFrame:
    return _threaded(spark, d).select("row_idx", "thread_id")


def grouping_method(spark: SparkSession, d: str) -> DataFrame:
    return threads.with_grouping(_threaded(spark, d), "jaccard").groupBy("grouping_method").agg(F.count(F.lit(1)).alias("n"))


def thread_summary(spark: SparkSession, d: str) -> DataFrame:
    more = table(spark, d, "thread_grouper").select("row_idx", "timestamp", F.filter(F.split(F.coalesce("participants_str", F.lit("")), "; "), lambda x: x != "").alias("participants"))
    s = threads.thread_summary(_threaded(spark, d).join(more, "row_idx"), "jaccard")
    return s.select(
        "thread_id", F.array_join("constituent_eids", "|").alias("eids"), F.array_join("participant_list", "|").alias("people"),
        F.col("timestamp_range.earliest").alias("earliest"), F.col("timestamp_range.latest").alias("latest"), "email_count", "grouping_method",
    )


def thread_size_stats(spark: SparkSession, d: str) -> DataFrame:
    return threads.size_stats(_threaded(spark, d).groupBy("thread_id").agg(F.count(F.lit(1)).alias("email_count")))


def thread_export(spark: SparkSession, d: str) -> DataFrame:
    """The export: fourteen columns, line breaks of bodies squeezed, ordered by thread."""
    from lettermill import schemas
    from lettermill.sources.io import squeezed

    rest = table(spark, d, "thread_grouper").drop("eid", "thread_id", "grouping_method", "mailbox_id")
    out = threads.with_grouping(_threaded(spark, d), "jaccard").join(rest, "row_idx").orderBy("thread_id", "row_idx")
    return squeezed(out.select("row_idx", *schemas.EXPORT), "cleaned_body", "body_text")


def thread_top10(spark: SparkSession, d: str) -> DataFrame:
    s = _threaded(spark, d).groupBy("thread_id").agg(F.count(F.lit(1)).alias("n"))
    return s.orderBy(F.desc("n"), F.asc("thread_id")).limit(10)


def thread_metrics(spark: SparkSession, d: str) -> DataFrame:
    rows = Scratch(spark, "metrics").cut(table(spark, d, "thread_grouper").withColumn("toks", similarity.tokens(F.col("body_text"))).select("row_idx", "toks", "body_text"))
    comps = Scratch(spark, "metrics").cut(threads.clusters(rows, _edges(spark, d)))
    return threads.metrics(comps, threads.pairs_inside(rows, comps, "toks"), "Jaccard", DEFAULT.jaccard_threshold)


def _both(spark: SparkSession, d: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Both methods over the first row of each mail, with the id links of the edge table."""
    rows = Scratch(spark, "both").cut(_mails(spark, d).select("row_idx", "eid", "body_text"))
    e = table(spark, d, "edges").where("match_method = 'message_id' and i <> j").select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).distinct()
    have = rows.select("row_idx")
    links = e.join(have.withColumnRenamed("row_idx", "i"), "i", "left_semi").join(have.withColumnRenamed("row_idx", "j"), "j", "left_semi")
    return {"rows": (rows, rows), **threads.evaluate(rows, Scratch(spark, "both").cut(links.select("i", "j")))}


def thread_method_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The eleven metrics of both methods."""
    both = _both(spark, d)
    return both["tfidf"][1].union(both["jaccard"][1])


def thread_flagship(spark: SparkSession, d: str) -> DataFrame:
    """End to end: both methods are run, the one with the better cohesion names the threads."""
    both = _both(spark, d)
    rows = both.pop("rows")[0]
    method = threads.choose(both)
    sizes = threads.thread_ids(rows, both[method][0]).groupBy("thread_id").agg(F.count(F.lit(1)).alias("n"))
    return sizes.select("thread_id", "n", threads.grouping_method(F.col("n"), method).alias("grouping_method"))


# ---------------------------------------------------------------- bulk filter


def weak_label_rows(spark: SparkSession, d: str) -> DataFrame:
    return bulk.with_labels(_raw(spark, d), "raw_body").select("row_idx", "label", "category")


def weak_label_counts(spark: SparkSession, d: str) -> DataFrame:
    return bulk.with_labels(_raw(spark, d), "raw_body").groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def bulk_features(spark: SparkSession, d: str) -> DataFrame:
    r = _raw(spark, d).withColumn("clean_text", F.lower("raw_body"))
    return bulk.with_features(r).select("row_idx", *bulk.FEATURES)


def ml_text_normalize(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).where("raw_body is not null").select("row_idx", bulk.normalized(F.col("raw_body")).alias("text"))


def _bulk_data(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw(spark, d).withColumn("raw_body", F.coalesce("raw_body", F.lit("")))
    return Scratch(spark, "bulk").cut(bulk.clean_for_model(bulk.with_labels(raw, "raw_body"), "raw_body").select("row_idx", "label", "clean_text"))


def two_gate_filter(spark: SparkSession, d: str) -> DataFrame:
    """Trained on the weak labels of four fifths of the mails, applied to every mail."""
    data = _bulk_data(spark, d)
    split = Scratch(spark, "bulk-split").cut(bulk.stratified_split(data, "row_idx", "label"))
    return bulk.classify(data, bulk.train(split.where("not is_test"), fit_on=data)).select("row_idx", "is_filtered")


def bulk_report(spark: SparkSession, d: str) -> DataFrame:
    """Held-out precision, recall and F1 of the model."""
    data = _bulk_data(spark, d)
    split = Scratch(spark, "bulk-report").cut(bulk.stratified_split(data, "row_idx", "label"))
    model = bulk.train(split.where("not is_test"), fit_on=data)
    scored = bulk.score(split.where("is_test"), model).withColumn("predicted", (F.col("automation_probability") >= 0.5).cast("int"))
    return bulk.class_report(bulk.confusion(scored, "label", "predicted"))


#: a model whose coefficients follow a rule, so that SQL can score with it too
FIXED_FEATURES, FIXED_INTERCEPT = (0.9, 0.8, 0.7, 0.6, 0.5, -0.001, 0.05, -0.02), -0.25


def bulk_fixed_scores(spark: SparkSession, d: str) -> DataFrame:
    """Weights, scores and both gates with stored coefficients over the first row of each mail."""
    rows = Scratch(spark, "fixed").cut(_mails(spark, d).select("row_idx", bulk.normalized(F.coalesce("cleaned_body", F.lit(""))).alias("clean_text")))
    counts = similarity.term_counts(rows, "row_idx", "clean_text")
    terms = similarity.fit_vocabulary(counts, rows.count(), DEFAULT.bulk_vocabulary, DEFAULT.max_df, DEFAULT.bulk_min_df)
    model = bulk.BulkModel(terms.select("term", "idf", (F.length("term") % 7 - 3).cast("double").alias("coef")), FIXED_FEATURES, FIXED_INTERCEPT)
    return bulk.classify(rows, model).select("row_idx", F.round("automation_probability", 6).alias("p"), "is_filtered")


def filtered_split(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of the genuine and the filtered part under the phrase gate."""
    rows = _raw(spark, d).withColumn("is_filtered", (bulk.weak_category(F.col("raw_body")) != "genuine").cast("int"))
    genuine, filtered = bulk.split_filtered(rows)
    n = lambda x, name: x.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("raw_body")), F.lit(0)).alias("chars"))
    return n(genuine, "genuine").union(n(filtered, "filtered"))


def label_confusion(spark: SparkSession, d: str) -> DataFrame:
    lab = table(spark, d, "labeled").where("label is not null")
    return bulk.confusion(lab.withColumn("predicted", (bulk.weak_category(F.col("text")) != "genuine").cast("int")), "label", "predicted")


def label_report(spark: SparkSession, d: str) -> DataFrame:
    """Precision, recall and F1 of the weak labels against the given ones."""
    r = bulk.class_report(label_confusion(spark, d))
    return r.select("class", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"), F.round("f1", 6).alias("f1"), "support")


_NAMES = (
    "dedup_keep_first dedup_keep_last dedup_stats point_lookup first_sample reply_chain_cut disclaimer_removal signature_removal signature_removal_truncate line_noise quote_strip "
    "inline_signatures blank_collapse link_cleanup html_sniff header_lines header_blocks line_classes clean_body_keep clean_body_truncate html_to_text clean_length_stats body_length_counts "
    "extract_sender extract_recipients extract_cc extract_addresses extract_subject extract_date reply_depth token_sets token_doc_freq jaccard_pairs jaccard_near_identical tfidf_weights "
    "tfidf_bulk_terms cosine_pairs message_id_links thread_components thread_duplicate_split thread_ids grouping_method thread_summary thread_top10 thread_metrics thread_flagship "
    "thread_size_stats thread_export thread_method_metrics header_block_metadata header_lines_dropped stitched_headers finished_text layers_truncate first_address field_counts extract_timestamp "
    "bulk_fixed_scores filtered_split weak_label_rows weak_label_counts bulk_features ml_text_normalize two_gate_filter bulk_report label_confusion label_report signature_parts corpus_titles"
)
QUERIES = {n: globals()[n] for n in _NAMES.split()}

from lettermill.plans.mail_sql import SQL  # noqa: E402, F401
