"""Metadata from a raw body: addresses, headers, date, depth. Expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill import rx
from lettermill.functions.instants import text_to_millis
from lettermill.operators.lines import has, header_flags, split_lines, strip
from lettermill.rx import LB, RB

_ONE = rx.ADDRESS


def all_addresses(text: Column) -> Column:
    """Distinct lower-cased addresses, sorted."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_ONE), F.lit(0)), F.lower)))


def _first(*choices: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices], F.lit(""))


def _bare(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, "^[<>]+|[<>]+$", ""))


def sender(raw: Column) -> Column:
    """From a reply header, else a From field, else the first mailto link; empty without one."""
    wrote = F.regexp_extract(raw, rf"On{rx.S}+[^\n]{{10,60}}?{rx.S}+({rx.NS}+@{rx.NS}+\.\w+){rx.S}*>?{rx.S}*wrote:", 1)
    field = F.regexp_extract(raw, rf"(?i)From:{rx.S}*(?:<[^>]*>)?{rx.S}*({rx.NS}+@{rx.NS}+\.\w+)", 1)
    link = F.regexp_extract(raw, f"mailto:({_ONE})", 1)
    return _first(_bare(wrote), _bare(field), F.lower(link))


def header_value(raw: Column, field: str) -> Column:
    """The text after the first ``field:`` up to the end of the line, a ``<br`` or the text's end."""
    return F.regexp_extract(raw, rf"(?i){field}:{rx.S}*([^\n]+?)(?:\r?\n|<br|$)", 1)


def addresses_of(raw: Column, field: str) -> Column:
    return F.array_join(all_addresses(header_value(raw, field)), "; ")


def subject(raw: Column) -> Column:
    return F.substring(strip(F.regexp_replace(header_value(raw, "Subject"), "<[^>]+>", "")), 1, 200)


def date_text(raw: Column) -> Column:
    short = F.regexp_extract(raw, rf"On{rx.S}+{rx.W}{{3}},{rx.S}+({rx.W}{{3}}{rx.S}+\d{{1,2}},{rx.S}+\d{{4}}){rx.S}+at{rx.S}+[\d:]+{rx.S}*[APap][Mm]", 1)
    field = F.substring(strip(header_value(raw, "Date")), 1, 50)
    loose = F.regexp_extract(raw, rf"({rx.W}+{rx.S}+\d{{1,2}},{rx.S}+\d{{4}})", 1)
    # an empty Date field is still the field's answer
    return F.when(short != "", short).when(raw.rlike(rf"(?i)Date:{rx.S}*[^\n]+?(?:\r?\n|<br|$)"), field).otherwise(loose)


def reply_depth(raw: Column) -> Column:
    return F.greatest(F.regexp_count(raw, F.lit("(?i)wrote:")), F.regexp_count(raw, F.lit("(?i)<blockquote"))).cast("int")


def first_address(text: Column) -> Column:
    """The first address, lower case, without the marks around it; empty without one. The domain may end in a dot."""
    found = F.regexp_extract(F.coalesce(text, F.lit("")), r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+", 0)
    return F.lower(strip(found, r"<>(): \t_"))


_FROM_WORD = LB + "(?:from|von|de|envoyé|enviado)" + RB
_TO_WORD = LB + "(?:to|an|à|para)" + RB


def header_block_metadata(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, pos, n_lines, sender, recipient, depth)`` of each block of header lines in ``text``.

    The last line that names a sender (else a recipient) counts; the address stands in it or in the next
    line of the block; without a sender line the first address of the block is the sender's. Depth is the
    most quote marks before a line of the block.
    """
    raw = df.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), split_lines(F.col(text)).alias("ls"))
    flagged = raw.select("key", F.posexplode(F.arrays_zip(F.col("ls").alias("line"), header_flags(F.col("ls")).alias("head"))).alias("pos", "z")).select("key", "pos", "z.line", "z.head").where("head")
    # lines of one block lie on end: position less rank is the same
    w = Window.partitionBy("key").orderBy("pos")  # the lines of one text
    block = flagged.withColumn("block", F.col("pos") - F.row_number().over(w))
    inside = Window.partitionBy("key", "block").orderBy("pos")
    mail = first_address(F.col("line"))
    near = F.coalesce(F.nullif(mail, F.lit("")), F.nullif(F.lead(mail).over(inside), F.lit("")))
    sends, gets = has(F.col("line"), _FROM_WORD), has(F.col("line"), _TO_WORD)
    marks = F.length(F.regexp_replace(F.regexp_extract("line", f"^[{rx.WS}>]*", 0), "[^>]", ""))
    lines = block.select("key", "block", "pos", mail.alias("mail"), near.alias("near"), sends.alias("sends"), (gets & ~sends).alias("gets"), marks.alias("marks"))
    got = lines.groupBy("key", "block").agg(
        F.min("pos").alias("pos"), F.count(F.lit(1)).alias("n_lines"),
        F.max_by(F.when(F.col("sends"), F.col("near")), F.when(F.col("sends") & F.col("near").isNotNull(), F.col("pos"))).alias("s"),
        F.max_by(F.when(F.col("gets"), F.col("near")), F.when(F.col("gets") & F.col("near").isNotNull(), F.col("pos"))).alias("recipient"),
        F.min_by("mail", F.when(F.col("mail") != "", F.col("pos"))).alias("any"), F.max("marks").alias("depth"),
    )
    return got.select(F.col("key").alias(key), "pos", "n_lines", F.coalesce("s", "any", F.lit("")).alias("sender"), F.coalesce("recipient", F.lit("")).alias("recipient"), "depth")


def corpus_title(name: Column) -> Column:
    """A title from a file's stem: blanks for underscores, words with a capital."""
    return F.initcap(F.regexp_replace(name, "_", " "))


def field_counts(df: DataFrame) -> DataFrame:
    """Mails with a sender, a date and a subject."""
    full = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) != "").alias(f"with_{c.removesuffix('_addr')}")
    return df.agg(F.count(F.lit(1)).alias("mails"), full("from_addr"), full("date"), full("subject"))


def with_metadata(df: DataFrame, raw: str = "raw_body") -> DataFrame:
    """Adds sender, recipients, subject, date, its instant in UTC milliseconds, depth and participants. Null bodies count as empty; a date without zone is UTC."""
    r = F.coalesce(F.col(raw), F.lit(""))
    people = all_addresses(r)
    out = df.withColumns(
        {
            "from_addr": sender(r), "to_addr": addresses_of(r, "To"), "cc_addr": addresses_of(r, "Cc"), "subject": subject(r), "date": date_text(r),
            "reply_depth": reply_depth(r), "participants": people, "participant_count": F.size(people),
            "participants_str": F.array_join(people, "; "), "__tz": F.lit(None).cast("string"), "__order": F.lit(None).cast("string"),
        }
    )
    return text_to_millis(out, "date", "__tz", "__order", "timestamp").drop("__tz", "__order")
