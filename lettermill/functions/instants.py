"""Mixed date texts and bare epoch counts to UTC milliseconds, inside the JVM.

Every accepted layout is one branch of a single alternation with named groups.
The alternation runs once per value: one ``regexp_replace`` writes all groups
into a separated record, which is split into components. Calendar ranges are
then checked and the instant is put together with integer day arithmetic; only
values in a named region need the zone tables.

Defined results: null, empty or blank text, text without a full date, an
impossible date or time, and a count that fits no unit give null. A time of
the day that occurs twice is the earlier instant, a skipped one is read with
the offset before the jump, two-digit years are 20xx, finer parts than a
millisecond are cut off and missing parts are zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: month names of the five languages of the mail programs, by number
MONTHS: dict[int, str] = {
    1: "january jan januar januar. jänner janvier janv enero ene janeiro",
    2: "february feb februar février fevrier févr febrero fevereiro fev",
    3: "march mar märz maerz mrz mars marzo março marco",
    4: "april apr avril avr abril abr",
    5: "may mai mayo maio",
    6: "june jun juni juin junio junho",
    7: "july jul juli juillet juil julio julho",
    8: "august aug août aout agosto ago",
    9: "september sep sept septembre septiembre setembro set",
    10: "october oct oktober okt octobre octubre outubro out",
    11: "november nov novembre noviembre novembro",
    12: "december dec dezember dez décembre decembre déc diciembre dic dezembro",
}
# fixed values: zone abbreviations in minutes east of UTC
ZONES: dict[str, int] = {
    "UTC": 0, "GMT": 0, "Z": 0, "UT": 0, "WET": 0, "BST": 60, "WEST": 60, "CET": 60, "MEZ": 60, "CEST": 120, "MESZ": 120,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
    "IST": 330, "AEST": 600, "AEDT": 660, "BRT": -180, "BRST": -120,
}

_SEP = "\u0001"
_S = r"[\s    ]"
_MON = r"(?<MON>" + "|".join(sorted({w.rstrip(".") for ws in MONTHS.values() for w in ws.split()}, key=lambda w: (-len(w), w))) + r")\.?"
_WD = rf"(?:[\p{{L}}]{{2,12}}\.?,?{_S}+)?"
_T = r"(?<h>\d{1,2}):(?<mi>\d{2})(?::(?<s>\d{2})(?:[.,](?<f>\d{1,9})\d*)?)?"
_AP = rf"(?:{_S}*(?<ap>[AaPp])\.?{_S}?[Mm](?![\p{{L}}])\.?)?"
_OFF = r"(?:GMT|UTC)?(?<sg>[+-])(?<oh>\d{2}):?(?<om>\d{2})"
_ZN = r"(?<zn>" + "|".join(sorted(ZONES, key=lambda z: (-len(z), z))) + r")"
_RG = r"(?<rg>[A-Z][A-Za-z]+(?:/[A-Za-z_+\-]+)+)"
_ZONE = rf"(?:{_S}*(?:{_OFF}|{_ZN}|\(?{_RG}\)?)(?:{_S}*\([A-Za-z {_S}]+\))?)?"

#: one branch a layout; names are made unique by the branch's number
LAYOUTS: tuple[str, ...] = (
    # 2024-01-14 20:46:36.5 +01:00, 2024/01/09 16:51, 20240114T132704Z
    rf"(?<y>\d{{4}})[-/.](?<m>\d{{1,2}})[-/.](?<d>\d{{1,2}})(?:(?:[Tt]|,?{_S}+){_T}{_AP}{_ZONE})?",
    rf"(?<y>\d{{4}})(?<m>\d{{2}})(?<d>\d{{2}})(?:[Tt]?(?<h>\d{{2}})(?<mi>\d{{2}})(?<s>\d{{2}})?(?:[.,](?<f>\d{{1,9}})\d*)?{_ZONE})?",
    # ordinal day, week date
    rf"(?<y>\d{{4}})-?(?<doy>\d{{3}})(?:[Tt]{_T}{_ZONE})?",
    rf"(?<y>\d{{4}})-?W(?<w>\d{{2}})-?(?<wd>\d)(?:[Tt]{_T}{_ZONE})?",
    # 09.01.2024 10:52 Uhr: with dots the day comes first
    rf"{_WD}(?<d>\d{{1,2}})\.{_S}?(?<m>\d{{1,2}})\.{_S}?(?<y>\d{{4}}|\d{{2}})(?:,?{_S}+(?:(?:um|at|à){_S}+)?{_T}{_AP}(?:{_S}*Uhr)?{_ZONE})?",
    # 10/01/2024 12:57, 05-18-2026, 8/1/24 5:53 am: the order is the mailbox's
    rf"{_WD}(?<a>\d{{1,2}})(?<sep>[/-])(?<b>\d{{1,2}})\k<sep>(?<y>\d{{4}}|\d{{2}})(?:,?{_S}+(?:at{_S}+)?{_T}{_AP}(?:{_S}*Uhr)?{_ZONE})?",
    # Thu Jan 11 03:31:27 [UTC] 2024
    rf"(?:[\p{{L}}]{{2,12}},?{_S}+){_MON}{_S}+(?<d>\d{{1,2}}){_S}+{_T}(?:{_S}+(?:{_OFF}|{_ZN}))?{_S}+(?<y>\d{{4}})",
    # Wed May 27 2026 15:55:05 GMT+0100, January 10, 2024, Jan 16, 2024 at 9:50 PM
    rf"{_WD}{_MON}{_S}+(?<d>\d{{1,2}})(?:st|nd|rd|th)?,?{_S}+(?<y>\d{{4}})(?:,?{_S}+(?:at{_S}+)?{_T}{_AP}{_ZONE})?",
    # Sun, 14 Jan 2024 06:54:30 +1100, 15 JAN 24 06:07 GMT, 13 janvier 2024 à 21h39, 14. Januar 2024 23:14, 9 de enero de 2024, 16:51
    rf"{_WD}(?<d>\d{{1,2}})(?:er|\.|º)?{_S}+(?:de{_S}+)?{_MON},?{_S}+(?:de{_S}+)?(?<y>\d{{4}}|\d{{2}})"
    rf"(?:,?{_S}+(?:(?:à|um|at|às|a las){_S}+)?(?<h>\d{{1,2}})(?::|{_S}?h{_S}?)(?<mi>\d{{2}})(?::(?<s>\d{{2}})(?:[.,](?<f>\d{{1,9}})\d*)?)?{_AP}(?:{_S}*Uhr)?{_ZONE})?",
    # a bare count, perhaps with decimals
    r"(?<n>-?\d{1,19})(?:\.(?<nf>\d{1,9}))?",
)
FIELDS = ("y", "m", "MON", "d", "a", "b", "sep", "doy", "w", "wd", "h", "mi", "s", "f", "ap", "sg", "oh", "om", "zn", "rg", "n", "nf")


def _alternation() -> tuple[str, str]:
    """The pattern, and the replacement that writes every field once."""
    import re

    names: dict[str, list[str]] = {f: [] for f in FIELDS}
    branches = []
    for i, layout in enumerate(LAYOUTS):
        seen: dict[str, int] = {}

        def unique(m: re.Match, i: int = i, seen: dict[str, int] = seen) -> str:
            name = m.group(1)
            seen[name] = seen.get(name, 0) + 1
            new = f"{name}x{i}x{seen[name]}".replace("_", "")
            names[name].append(new)
            return f"(?<{new}>"

        body = re.sub(r"\(\?<([A-Za-z]+)>", unique, layout)
        body = re.sub(r"\\k<([A-Za-z]+)>", lambda m, i=i: rf"\\k<{m.group(1)}x{i}x1>".replace("\\\\", "\\"), body)
        branches.append(f"(?:{body})")
    pattern = rf"(?iu)\A{_S}*(?:" + "|".join(branches) + rf"){_S}*\z"
    record = _SEP.join("".join(f"${{{x}}}" for x in names[f]) for f in FIELDS)
    return pattern, _SEP + record


PATTERN, RECORD = _alternation()


def days_from_civil(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 by integer arithmetic on years that begin in March."""
    y2 = F.when(m <= 2, y - 1).otherwise(y)
    era = F.floor(y2 / 400)
    yoe = y2 - era * 400
    doy = F.floor((153 * (m + F.when(m > 2, -3).otherwise(9)) + 2) / 5) + d - 1
    doe = yoe * 365 + F.floor(yoe / 4) - F.floor(yoe / 100) + doy
    return era * 146097 + doe - 719468


def _leap(y: Column) -> Column:
    return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)


#: the first millisecond of 2023 and of 2028
_FROM, _TO = 1672531200000, 1830297600000


def epoch_millis(n: Column, decimals: Column | None = None) -> Column:
    """A count of s, ms, us or ns to milliseconds, in the unit that puts it into 2023-2027; else null."""
    frac = F.lit(0).cast("long") if decimals is None else F.coalesce(F.rpad(decimals, 9, "0").cast("long"), F.lit(0).cast("long"))
    s_ms = n * 1000 + F.floor(frac / 1_000_000)
    inside = lambda x: (x >= _FROM) & (x < _TO)
    return (
        F.when((n.between(_FROM // 1000, _TO // 1000 - 1)), s_ms)
        .when(inside(n), n)
        .when(inside(F.floor(n / 1000)), F.floor(n / 1000))
        .when(inside(F.floor(n / 1_000_000)), F.floor(n / 1_000_000))
    ).cast("long")


def known_zones(spark: SparkSession) -> list[str]:
    return sorted(spark.sparkContext._jvm.java.time.ZoneId.getAvailableZoneIds())


def text_to_millis(df: DataFrame, text: str, tz: str, order: str, out: str) -> DataFrame:
    """Adds ``out``: UTC milliseconds of the date text in column ``text``.

    ``tz`` and ``order`` are the columns with the local zone and ``mdy``/``dmy``; null means UTC and dmy.
    Working columns are nested in one struct, so that columns of the input cannot clash with them.
    """
    keep = df.columns
    i = lambda name: F.try_element_at(F.col("__lm_p"), F.lit(FIELDS.index(name) + 2))
    num = lambda name: i(name).try_cast("long")
    # a text that does not match stays without the separator and gives a record of one element
    df = df.withColumn("__lm_r", F.regexp_replace(F.col(text), PATTERN, RECORD))
    df = df.withColumn("__lm_p", F.when(F.substring("__lm_r", 1, 1) == _SEP, F.split("__lm_r", _SEP)))
    mon = F.lower(i("MON"))
    month_of = F.create_map(*[F.lit(x) for n, ws in MONTHS.items() for w in sorted({w.rstrip(".") for w in ws.split()}) for x in (w, n)])
    mdy = F.coalesce(F.col(order), F.lit("dmy")) == "mdy"
    year = F.when(F.length(i("y")) == 2, num("y") + 2000).otherwise(num("y"))
    zone_of = F.create_map(*[F.lit(x) for z, m in ZONES.items() for x in (z, m)])
    df = df.withColumn(
        "__lm_c",
        F.struct(
            year.alias("y"),
            F.when(F.length(mon) > 0, F.try_element_at(month_of, mon).cast("long"))
            .when(num("a").isNotNull(), F.when(mdy, num("a")).otherwise(num("b")))
            .otherwise(num("m"))
            .alias("m"),
            F.when(num("a").isNotNull(), F.when(mdy, num("b")).otherwise(num("a"))).otherwise(num("d")).alias("d"),
            num("doy").alias("doy"),
            num("w").alias("w"),
            num("wd").alias("wd"),
            F.coalesce(num("h"), F.lit(0)).alias("h0"),
            F.coalesce(num("mi"), F.lit(0)).alias("mi"),
            F.coalesce(num("s"), F.lit(0)).alias("s"),
            F.coalesce(F.substring(F.rpad(i("f"), 3, "0"), 1, 3).try_cast("long"), F.lit(0)).alias("ms"),
            F.lower(i("ap")).alias("ap"),
            F.when(F.length(i("sg")) > 0, F.when(i("sg") == "-", -1).otherwise(1) * (num("oh") * 60 + num("om")))
            .when(F.length(i("zn")) > 0, F.try_element_at(zone_of, F.upper(i("zn"))).cast("long"))
            .alias("off"),
            F.when(F.length(i("rg")) > 0, i("rg")).alias("rg"),
            F.when(num("oh") > 15, F.lit(False)).when(num("om") > 59, F.lit(False)).otherwise(F.lit(True)).alias("off_ok"),
            F.when(F.length(i("n")) > 0, epoch_millis(num("n"), F.when(F.length(i("nf")) > 0, i("nf")))).alias("count"),
        ),
    )
    c = lambda name: F.col(f"__lm_c.{name}")
    month_days = F.element_at(F.array(*[F.lit(x) for x in (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)]), F.greatest(F.lit(1), F.least(F.lit(12), c("m"))).cast("int")) + F.when(
        (c("m") == 2) & _leap(c("y")), 1
    ).otherwise(0)
    one, jan = F.lit(1).cast("long"), days_from_civil(c("y"), F.lit(1).cast("long"), F.lit(1).cast("long"))
    jan4 = jan + 3
    week1 = jan4 - F.pmod(jan4 + 3, F.lit(7))  # the Monday of the week with 4 January
    last_week = F.when((F.pmod(jan + 3, F.lit(7)) == 3) | (_leap(c("y")) & (F.pmod(jan + 3, F.lit(7)) == 2)), 53).otherwise(52)
    days = (
        F.when(c("doy").isNotNull(), F.when((c("doy") >= 1) & (c("doy") <= 365 + F.when(_leap(c("y")), 1).otherwise(0)), jan + c("doy") - one))
        .when(c("w").isNotNull(), F.when(c("w").between(1, last_week) & c("wd").between(1, 7), week1 + (c("w") - 1) * 7 + c("wd") - 1))
        .when(c("m").between(1, 12) & (c("d") >= 1) & (c("d") <= month_days), days_from_civil(c("y"), c("m"), c("d")))
    )
    hour = F.when(F.length(c("ap")) > 0, F.when(c("h0").between(1, 12), c("h0") % 12 + F.when(c("ap") == "p", 12).otherwise(0))).otherwise(
        F.when(c("h0") <= 23, c("h0"))
    )
    # a leap second counts as the last second of its minute
    millis = ((days * 24 + hour) * 60 + F.when(c("mi") <= 59, c("mi"))) * 60_000 + F.when(c("s") <= 60, F.least(c("s"), F.lit(59))) * 1000 + c("ms")
    df = df.withColumn("__lm_l", F.when(c("y").between(1000, 9999) & c("off_ok"), millis).cast("long"))
    zone = F.coalesce(c("rg"), F.col(tz), F.lit("UTC"))
    # a region nobody knows gives null instead of ending the job
    zone = F.when(zone.isin(*known_zones(df.sparkSession)), zone)
    local = F.unix_millis(F.to_utc_timestamp(F.timestamp_millis(F.col("__lm_l")), zone))
    value = F.when(c("count").isNotNull(), c("count")).when(c("off").isNotNull(), F.col("__lm_l") - c("off") * 60_000).otherwise(local)
    return df.select(*[F.col(f"`{k}`") for k in keep], value.cast("long").alias(out))


def to_utc_millis(mails: DataFrame, mailboxes: DataFrame, key: str = "row_idx") -> DataFrame:
    """``(key, field, utc_ms)`` for each value of ``date`` and ``timestamp`` that denotes an instant.

    ``mailboxes`` is joined by equality and left to the optimizer: it broadcasts the table only
    while its measured size is under the session's threshold, else it shuffles both sides.
    """
    box = mailboxes.select(F.col("mailbox_id").alias("__box"), F.col("tz_name").alias("__tz"), F.col("date_order").alias("__order")).dropDuplicates(["__box"])
    m = mails.select(F.col(key).alias("__key"), F.col("date").alias("__date"), F.col("timestamp").cast("long").alias("__ts"), F.col("mailbox_id").alias("__mb"))
    m = m.join(box, F.col("__mb") == F.col("__box"), "left")
    m = text_to_millis(m, "__date", "__tz", "__order", "__d")
    both = F.array(
        F.struct(F.lit("date").alias("field"), F.col("__d").alias("utc_ms")),
        F.struct(F.lit("timestamp").alias("field"), epoch_millis(F.col("__ts")).alias("utc_ms")),
    )
    return (
        m.select(F.col("__key").alias(key), F.explode(F.filter(both, lambda x: x["utc_ms"].isNotNull())).alias("v"))
        .select(key, F.col("v.field").alias("field"), F.col("v.utc_ms").alias("utc_ms"))
    )
