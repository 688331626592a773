"""The quality audit: rules for each report, buckets for each batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import dims
from tidemark.functions import text as T
from tidemark.functions.numbers import share


def _lines(c: Column) -> Column:
    return F.split(c, "\n")


def _full_lines(section: Column) -> Column:
    return F.size(F.filter(_lines(T.strip(section)), lambda x: T.strip(x) != ""))


def english(content: Column) -> Column:
    """The first indicator in the first lines that hold neither bold text nor a colon; null without one."""
    plain = F.filter(F.slice(_lines(content), 1, dims.ENGLISH_LINES), lambda x: ~x.contains("**") & ~x.contains(":"))
    hits = F.transform(plain, lambda x: F.get(F.filter(F.lit(dims.ENGLISH_INDICATORS), lambda i: x.contains(i)), F.lit(0)))
    return F.get(F.filter(hits, lambda x: x.isNotNull()), F.lit(0))


def placeholders(content: Column) -> Column:
    return F.filter(F.lit(dims.PLACEHOLDERS), lambda p: content.contains(p))


def generic(names: Column) -> Column:
    """The names that hold a generic marker, repeats included."""
    return F.filter(names, lambda n: F.exists(F.lit(dims.GENERIC_MARKERS), lambda m: n.contains(m)))


def _metadata_issue(content: Column, field: str, strict: bool) -> Column:
    line = F.get(F.filter(_lines(content), lambda x: x.contains(field)), F.lit(0))
    rest = T.strip(F.substring_index(line, field, -1) if strict else F.right(line, F.char_length(line) - F.position(F.lit(field), line) - len(field) + 1))
    if strict:
        rest = T.strip(F.regexp_replace(rest, r"^\*\*", ""))
    return F.when(~content.contains(field), f"Missing metadata: {field}").when((rest == "") | line.contains("(待更新)"), f"Empty metadata: {field}")


def audit(reports: DataFrame, strict_metadata: bool = False) -> DataFrame:
    """Adds is_clean, issues (in the rules' order), bucket, mention_count, supply_lines, customer_lines.

    A short text has only that issue. By default an empty bold field passes, since the bold mark behind its colon counts as a
    value; strict_metadata mends that.
    """
    c = F.col("content")
    rows = reports.withColumns(
        {
            "_names": T.mentions(c),
            "_english": english(c),
            "_placeholders": placeholders(c),
            "_supply": F.regexp_extract(c, r"(?s)## 供應鏈位置\n(.*?)(?=\n## 主要客戶及供應商|\z)", 1),
            "_customers": F.regexp_extract(c, r"(?s)## 主要客戶及供應商\n(.*?)(?=\n## 財務概況|\z)", 1),
        }
    )
    rows = rows.withColumns({"mention_count": F.size("_names"), "_generic": generic(F.col("_names")), "supply_lines": _full_lines(F.col("_supply")), "customer_lines": _full_lines(F.col("_customers"))})
    has_supply, has_customers = c.contains("## 供應鏈位置\n"), c.contains("## 主要客戶及供應商\n")
    one = lambda condition, text: F.when(condition, text)
    rules = F.array_compact(
        F.concat(
            F.transform("_placeholders", lambda p: F.concat(F.lit("Placeholder found: '"), p, F.lit("'"))),
            F.array(one(F.col("_english").isNotNull(), F.concat(F.lit("English text detected: '"), "_english", F.lit("'")))),
            F.array(*[one(~c.contains(s), F.lit(f"Missing section: {s}")) for s in dims.REQUIRED_SECTIONS]),
            F.array(*[_metadata_issue(c, f, strict_metadata) for f in dims.REQUIRED_METADATA]),
            F.array(
                one(F.col("mention_count") < dims.MIN_MENTIONS, F.format_string(f"Only %d wikilinks (minimum {dims.MIN_MENTIONS})", "mention_count")),
                one(F.size("_generic") > 0, F.concat(F.format_string("Generic wikilinks (%d): ['", F.size("_generic")), F.array_join("_generic", "', '"), F.lit("']"))),
                one(has_supply & (F.col("supply_lines") < dims.MIN_SUPPLY_LINES), F.format_string("Supply chain too thin (%d lines)", "supply_lines")),
                one(has_customers & (F.col("customer_lines") < dims.MIN_CUSTOMER_LINES), F.format_string("Customers/suppliers too thin (%d lines)", "customer_lines")),
            ),
        )
    )
    short = F.char_length(c) < dims.MIN_CHARS
    issues = F.when(short, F.array(F.lit(f"Content too short (<{dims.MIN_CHARS} chars)"))).otherwise(rules)
    out = rows.withColumn("issues", issues).withColumn("is_clean", F.size("issues") == 0)
    bucket = F.when(F.col("is_clean"), "CLEAN").when(short | (F.size("_placeholders") > 0) | F.col("_english").isNotNull(), "ENRICHMENT").otherwise("QUALITY_FIX")
    return out.withColumn("bucket", bucket).select(*reports.columns, "is_clean", "issues", "bucket", "mention_count", "supply_lines", "customer_lines")


def audit_batches(batches: DataFrame, audited: DataFrame) -> DataFrame:
    """batch_no, sector, ticker, ord, bucket of every listed ticker: MISSING without a report."""
    return batches.join(audited.select("ticker", "bucket"), "ticker", "left").select("batch_no", "sector", "ticker", "ord", F.coalesce("bucket", F.lit("MISSING")).alias("bucket"))


def batch_scores(checked: DataFrame, count_missing: bool = True) -> DataFrame:
    """batch_no (null: all), tickers, the buckets' counts and the score, rounded per cent of clean ones.

    A batch's own score counts missing tickers; over all batches (count_missing False) they are left out.
    """
    buckets = ["CLEAN", "ENRICHMENT", "QUALITY_FIX", "MISSING"]
    agg = checked.rollup("batch_no").agg(F.count("*").alias("tickers"), *[F.count_if(F.col("bucket") == b).alias(b.lower()) for b in buckets])
    whole = F.col("tickers") if count_missing else F.col("tickers") - F.col("missing")
    return agg.withColumn("score", F.bround(share(F.col("clean"), whole)).cast("int"))


def batch_lists(checked: DataFrame) -> DataFrame:
    """batch_no, bucket, tickers in the catalogue's order."""
    return checked.groupBy("batch_no", "bucket").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "ticker"))), lambda x: x["ticker"]).alias("tickers"))
