"""Statement metrics: derive, fill, pick periods, scale, print."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import dims
from tidemark.functions.numbers import margin, plain

KEY = ["ticker", "freq"]


def wide(landed: DataFrame) -> DataFrame:
    """ticker, freq, period and a column for each metric; `has <metric>` tells whether any of its keys was delivered for the ticker and frequency.

    The first delivered key counts, even if it is null throughout. Rows of a period are put together in each task first; then those of a
    ticker and frequency meet, where presence is a window.
    """
    keys = {(s, k) for s, ks in dims.STATEMENT_KEYS.values() for k in ks}
    value = {(s, k): F.max(F.when((F.col("statement") == s) & (F.col("item") == k), F.col("value"))) for s, k in keys}
    there = {(s, k): F.max(F.when((F.col("statement") == s) & (F.col("item") == k), 1)) for s, k in keys}
    clean = landed.withColumn("value", F.nanvl("value", F.lit(None).cast("double")))
    rows = clean.groupBy(*KEY, "period").agg(*[c.alias(f"v {s} {k}") for (s, k), c in value.items()], *[c.alias(f"h {s} {k}") for (s, k), c in there.items()])
    w = Window.partitionBy(*KEY)
    rows = rows.withColumns({f"h {s} {k}": F.max(f"h {s} {k}").over(w).isNotNull() for s, k in keys})
    out = {}
    for metric, (s, ks) in dims.STATEMENT_KEYS.items():
        pick: Column | None = None
        for k in ks:
            pick = F.when(F.col(f"h {s} {k}"), F.col(f"v {s} {k}")) if pick is None else pick.when(F.col(f"h {s} {k}"), F.col(f"v {s} {k}"))
        out[metric] = pick
        has = F.lit(False)
        for k in ks:
            has = has | F.col(f"h {s} {k}")
        out[f"has {metric}"] = has
    return rows.select(*KEY, "period", *[c.alias(m) for m, c in out.items()])


def metrics(table: DataFrame) -> DataFrame:
    """Adds derived figures: general and admin expenses as SGA less selling, CAPEX as free less operating cash flow, margins.

    A gap is filled where the other figures exist; a figure that was not delivered at all is derived where they all were.
    """
    c = lambda m: F.col(f"`{m}`")
    has = lambda m: F.col(f"`has {m}`")
    admin = F.when(has("General & Admin Exp"), F.coalesce(c("General & Admin Exp"), F.when(has("SGA"), c("SGA") - c("Selling & Marketing Exp")))).when(has("SGA") & has("Selling & Marketing Exp"), c("SGA") - c("Selling & Marketing Exp"))
    capex = F.when(has("Op Cash Flow") & has("FCF"), F.coalesce(c("CAPEX"), c("FCF") - c("Op Cash Flow"))).otherwise(c("CAPEX"))
    out = table.withColumn("General & Admin Exp", admin).withColumn("CAPEX", capex)
    return out.withColumns({m: margin(c(over), c("Revenue")) for m, over in dims.MARGINS.items()}).select(*KEY, "period", *[c(m) for m in dims.METRICS])


def latest_periods(table: DataFrame, order: str | None = None, reported: bool = True) -> DataFrame:
    """The newest periods that report revenue, three years and four quarters, with their rank; amounts in millions.

    With ``order``, a column, the first ones by it; with reported False, whether they report revenue or not: periods as delivered.
    """
    w = Window.partitionBy(*KEY).orderBy(order or F.desc("period"))
    most = F.create_map(*[F.lit(x) for kv in dims.PERIODS.items() for x in kv])[F.col("freq")]
    rows = table.filter(F.col("Revenue").isNotNull()) if reported else table
    found = rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)
    scaled = [F.col(f"`{m}`") if "%" in m else (F.col(f"`{m}`") / 1_000_000).alias(m) for m in dims.METRICS]
    return found.select(*KEY, "period", "rank", *scaled)


def long(table: DataFrame) -> DataFrame:
    """ticker, freq, period, metric, value."""
    keep = [c for c in ("ticker", "freq", "period", "rank") if c in table.columns]
    return table.unpivot(keep, [F.col(f"`{m}`").alias(m) for m in dims.METRICS], "metric", "value")


def rendered(table: DataFrame) -> DataFrame:
    """ticker, freq, markdown: the printed table of each ticker and frequency, newest period first, a dash for nothing."""
    cells = F.array(*[plain(F.col(f"`{m}`")) for m in dims.METRICS])
    cols = table.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("rank", F.date_format("period", "yyyy-MM-dd").alias("head"), cells.alias("cells")))).alias("cols"))
    names = F.lit(dims.METRICS)
    first = max(len(m) for m in dims.METRICS)
    width = F.transform("cols", lambda x: F.greatest(F.char_length(x["head"]), F.array_max(F.transform(x["cells"], F.char_length))))
    row = lambda name, i: F.concat(F.lit("| "), F.rpad(name, F.lit(first), F.lit(" ")), F.lit(" | "), F.array_join(F.transform("cols", lambda x, j: F.lpad(F.get(x["cells"], i), F.get(width, j), F.lit(" "))), " | "), F.lit(" |"))
    head = F.concat(F.lit("| " + " " * first + " | "), F.array_join(F.transform("cols", lambda x, j: F.lpad(x["head"], F.get(width, j), F.lit(" "))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("|:" + "-" * (first + 1) + "|"), F.array_join(F.transform(width, lambda w: F.concat(F.repeat(F.lit("-"), w + 1), F.lit(":"))), "|"), F.lit("|"))
    body = F.transform(names, lambda name, i: row(name, i))
    return cols.select(*KEY, F.array_join(F.concat(F.array(head, rule), body), "\n").alias("markdown"))


CELL = r"\|\s*([^|]*?)\s*(?=\|)"


def parse_rendered(reports: DataFrame) -> DataFrame:
    """ticker, freq, period, metric, value read back from the printed tables of reports; a dash is null."""
    found = []
    for freq, title in (("A", dims.ANNUAL_HEADER), ("Q", dims.QUARTERLY_HEADER)):
        table = F.regexp_extract("content", rf"(?s){title}[^\n]*\n(.*?)(?=\n###|\z)", 1)
        found.append(reports.select("ticker", F.lit(freq).alias("freq"), F.filter(F.split(table, "\n"), lambda x: x.startswith("|")).alias("lines")))
    rows = found[0].unionByName(found[1]).filter(F.size("lines") > 2)
    cells = lambda x: F.regexp_extract_all(x, F.lit(CELL), F.lit(1))
    rows = rows.select("ticker", "freq", cells(F.get("lines", F.lit(0))).alias("head"), F.explode(F.slice("lines", 3, F.size("lines"))).alias("line")).withColumn("cells", cells(F.col("line")))
    each = rows.select("ticker", "freq", F.get("cells", F.lit(0)).alias("metric"), "head", F.posexplode("cells").alias("i", "cell")).filter("i > 0")
    return each.select("ticker", "freq", F.get("head", F.col("i")).try_cast("date").alias("period"), "metric", F.replace("cell", F.lit(","), F.lit("")).try_cast("double").alias("value"))


def finance_section(annual: Column, quarterly: Column, valuation: Column) -> Column:
    """The whole finance section; without a table it says so."""
    none = F.lit(dims.NO_DATA)
    return F.concat(
        F.lit(dims.FINANCE_TITLE + "\n"), F.coalesce(F.concat(valuation, F.lit("\n\n")), F.lit("")), F.lit(dims.ANNUAL_TITLE + "\n"), F.coalesce(annual, none), F.lit("\n\n" + dims.QUARTERLY_TITLE + "\n"), F.coalesce(quarterly, none), F.lit("\n")
    )


def finance_sections(printed: DataFrame, valuation: DataFrame) -> DataFrame:
    """ticker, section from printed tables and valuation blocks (ticker, block): one a ticker, with the least of several blocks."""
    by = printed.groupBy("ticker").agg(F.max(F.when(F.col("freq") == "A", F.col("markdown"))).alias("annual"), F.max(F.when(F.col("freq") == "Q", F.col("markdown"))).alias("quarterly"))
    return by.join(valuation.groupBy("ticker").agg(F.min("block").alias("block")), "ticker", "full").select("ticker", finance_section(F.col("annual"), F.col("quarterly"), F.col("block")).alias("section"))
