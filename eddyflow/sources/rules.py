"""IP rule files: ``|``-separated text, fields 2 and 3 the inclusive numeric
range, field 6 the province; other fields are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ip import number_to_ip
from ..functions.text import java_split

# Field positions of the rule line format (fixed by the original files).
RULE_START_FIELD = 2
RULE_END_FIELD = 3
RULE_PROVINCE_FIELD = 6
RULE_SEPARATOR = "|"


def parse_rule_lines(lines: DataFrame, value_col: str = "value", strict: bool = True) -> DataFrame:
    """``start_num, end_num, province`` from rule lines.

    Fields are split like Java's ``split("[|]")`` (trailing empty fields
    dropped).  Strict (default): a line with fewer than seven fields or a
    non-numeric bound fails the job, as the original loader does.  Otherwise the
    line itself and ``malformed`` are added, for ``split_rule_rejects``.
    """
    value = F.col(value_col)
    parts = java_split(value, RULE_SEPARATOR)
    start = F.get(parts, RULE_START_FIELD).try_cast("bigint")
    end = F.get(parts, RULE_END_FIELD).try_cast("bigint")
    bad = (F.coalesce(F.size(parts), F.lit(0)) < RULE_PROVINCE_FIELD + 1) | start.isNull() | end.isNull()
    province = F.get(parts, RULE_PROVINCE_FIELD).alias("province")
    if strict:
        guard = F.when(bad, F.raise_error(F.concat(F.lit("malformed ip rule: "), F.coalesce(value, F.lit("<null>")))))
        return lines.select(F.coalesce(guard.cast("bigint"), start).alias("start_num"), end.alias("end_num"), province)
    return lines.select(start.alias("start_num"), end.alias("end_num"), province, value.alias("line"),
                        bad.alias("malformed"))


def split_rule_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of permissively parsed rules: (rules, rejected lines)."""
    return (parsed.where(~F.col("malformed")).drop("line", "malformed"),
            parsed.where("malformed").select("line"))


def read_ip_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules from text files (local, HDFS or object store paths alike)."""
    return parse_rule_lines(spark.read.text(path))


def read_ip_rules_with_rejects(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rules, rejected lines) of text files that may hold bad lines."""
    return split_rule_rejects(parse_rule_lines(spark.read.text(path), strict=False))


def rule_line(start_num: Column, end_num: Column, fields: list[Column]) -> Column:
    """One rule line: start ip | end ip | start | end | fields[0..]."""
    return F.concat_ws("|", number_to_ip(start_num), number_to_ip(end_num),
                       start_num.cast("string"), end_num.cast("string"), *fields)


def rule_lines_from_nations(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Rule lines derived from the driver's tables.

    Nation ``n`` owns first octets ``16+4n .. 18+4n`` (so ``19+4n`` is a gap and
    octets above ``18+4*max(n)`` are outside every rule); the province is the
    nation's region name.  The lines go through the same parser as a file.
    """
    n = F.col("n_nationkey").cast("bigint")
    start = F.shiftleft(F.lit(16) + n * 4, 24)
    end = F.shiftleft(F.lit(19) + n * 4, 24) - 1
    joined = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    return joined.select(rule_line(start, end, [F.col("r_name"), F.col("n_name"), F.col("r_name")]).alias("value"))
