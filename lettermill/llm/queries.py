"""Queries of the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lettermill.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    from lettermill.llm.forms import same_look_pairs

    return same_look_pairs(table(spark, d, "armis_raw_email"), "row_idx", "raw_body")


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    from lettermill.llm.forms import same_look_groups

    return same_look_groups(table(spark, d, "armis_raw_email"), "row_idx", "raw_body")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    from lettermill.llm.personal import personal_spans

    return personal_spans(table(spark, d, "thread_grouper"), table(spark, d, "staff_directory"))


def p7_redacted(spark: SparkSession, d: str) -> DataFrame:
    from lettermill.llm.personal import redacted

    return redacted(table(spark, d, "thread_grouper"), table(spark, d, "staff_directory"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    from lettermill.llm.encode import token_ids

    return token_ids(table(spark, d, "documents"), "doc_id", "text")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    from lettermill.llm.similar import similar_pairs

    return similar_pairs(table(spark, d, "thread_grouper"), "eid", "body_text")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    from lettermill.llm.boilerplate import directory_names, repeated_lines

    return repeated_lines(table(spark, d, "armis_raw_email"), names=directory_names(table(spark, d, "staff_directory")))


def _clusters(spark: SparkSession, d: str) -> DataFrame:
    from lettermill.llm.boilerplate import directory_names, repeated_clusters

    return repeated_clusters(table(spark, d, "armis_raw_email"), names=directory_names(table(spark, d, "staff_directory")))[0]


def p4_clusters(spark: SparkSession, d: str) -> DataFrame:
    return _clusters(spark, d).selectExpr("row as row_idx", "line_no", "cluster")


def p4_kept(spark: SparkSession, d: str) -> DataFrame:
    """Bodies without the lines of frequent near-duplicate clusters."""
    from lettermill.llm.boilerplate import without_repeated_lines

    raw = table(spark, d, "armis_raw_email").select("row_idx", "raw_body")
    return without_repeated_lines(raw, _clusters(spark, d).selectExpr("row as row_idx", "line_no")).select("row_idx", "kept_body")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import functions as F

    from lettermill.llm.newtext import new_lines

    raw, mails, people = table(spark, d, "armis_raw_email"), table(spark, d, "thread_grouper"), table(spark, d, "staff_directory")
    a, b = new_lines([(raw, "row_idx", "raw_body"), (mails, "row_idx", "cleaned_body")], mails.select("eid", "from_addr"), people)
    named = lambda x, t: x.select(F.lit(t).alias("src_table"), "row_idx", "line_no")
    return named(a, "armis_raw_email").union(named(b, "thread_grouper"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    from lettermill.llm.groups import mail_groups

    return mail_groups(table(spark, d, "thread_grouper"), table(spark, d, "edges"))


def p9_mix_report(spark: SparkSession, d: str) -> DataFrame:
    from lettermill.llm.mixing import mix

    return mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p9_mix_selection(spark: SparkSession, d: str) -> DataFrame:
    from lettermill.llm.mixing import mix

    return mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    from lettermill.llm.quality import text_statistics

    return text_statistics(table(spark, d, "documents"), table(spark, d, "common_words")).where("kind <> 'prose'").select("doc_id", "kind")


def p10_statistics(spark: SparkSession, d: str) -> DataFrame:
    from lettermill.llm.quality import text_statistics

    return text_statistics(table(spark, d, "documents"), table(spark, d, "common_words"))


QUERIES = {
    "p1_found": p1_found,
    "p1_groups": p1_groups,
    "p2_found": p2_found,
    "p4_found": p4_found,
    "p4_clusters": p4_clusters,
    "p4_kept": p4_kept,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p7_found": p7_found,
    "p7_redacted": p7_redacted,
    "p8_ids": p8_ids,
    "p9_mix_report": p9_mix_report,
    "p9_mix_selection": p9_mix_selection,
    "p10_found": p10_found,
    "p10_statistics": p10_statistics,
}
SQL: dict[str, str] = {}
