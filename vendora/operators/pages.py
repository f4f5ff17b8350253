"""Facts from product pages: specification rows, embedded product data, prices, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import clean_text, let, number_value
from .nested import embedded_product
from .ordering import saved

#: Named character references that pages use in text.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def plain(html: Column) -> Column:
    """Text of a piece of a page: no tags or comments, character references resolved, white space folded."""

    def resolved(t: Column) -> Column:
        codes = F.array_distinct(F.concat(
            F.transform(F.regexp_extract_all(t, F.lit(r"(&#\d{1,7};)"), F.lit(1)), lambda x: F.struct(x.alias("ref"), F.hex(F.regexp_extract(x, r"(\d+)", 1).cast("long")).alias("code"))),
            F.transform(F.regexp_extract_all(t, F.lit(r"(?i)(&#x[0-9a-f]{1,6};)"), F.lit(1)), lambda x: F.struct(x.alias("ref"), F.regexp_extract(x, r"(?i)x([0-9a-f]+)", 1).alias("code"))),
        ))
        letter = lambda code: F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")
        out = F.aggregate(codes, t, lambda done, x: F.replace(done, x["ref"], letter(x["code"])))
        for name, c in ENTITIES:
            out = F.replace(out, F.lit(name), F.lit(c))
        return F.when(t.contains("&"), out).otherwise(t)

    t = let(F.regexp_replace(html, r"(?s)<!--.*?-->|<[^>]*>", ""), resolved)
    return clean_text(F.translate(t, "\u00a0", " "))


def spec_rows(df: DataFrame, key: str, html: str) -> DataFrame:
    """key, position, section, label, value of each table row with at least a label and a value.

    Three cells are section, label and value; two are label and value; a header cell alone opens a section that
    later rows carry on; a blank label falls back to the cell's data-spec. A null page has no row. Everything is a built-in
    expression; only the rows of one page meet in one group, to carry headings and sections.
    """
    # headings and rows in document order
    pieces = F.regexp_extract_all(F.col(html), F.lit(r"(?is)(<h[234]\b[^>]*>.*?</h[234]>|<tr\b[^>]*>.*?</tr>)"), F.lit(1))

    each = df.select(key, F.posexplode(pieces).alias("at", "x")).withColumn("is_row", F.col("x").rlike("(?i)^<tr"))
    w = Window.partitionBy(key).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    heading = F.when(~F.col("is_row"), F.coalesce(plain(F.col("x")), F.lit("")))
    each = each.withColumn("heading", F.nullif(F.last(heading, ignorenulls=True).over(w), F.lit(""))).withColumn("position", (F.sum(F.col("is_row").cast("int")).over(w) - 1).cast("int"))

    def cell(c: Column) -> Column:
        spec = F.regexp_extract(c, r"""(?is)^<t[dh]\b[^>]*?data-spec\s*=\s*["']([^"']*)""", 1)
        return F.struct(c.rlike("(?i)^<th").alias("head"), F.nullif(spec, F.lit("")).alias("spec"), plain(c).alias("text"))

    cells = F.transform(F.regexp_extract_all(F.col("x"), F.lit(r"(?is)(<t[dh]\b[^>]*>.*?</t[dh]>)"), F.lit(1)), cell)
    found = each.filter("is_row").select(key, "position", "heading", cells.alias("cells"))

    def read(c: Column) -> Column:
        n = F.size(c)
        first = F.when(n >= 3, 1).otherwise(0)
        a, b = F.get(c, first), F.get(c, first + 1)
        group = F.when(n >= 3, F.get(c, F.lit(0))["text"])
        label = F.coalesce(F.nullif(a["text"], F.lit("")), b["spec"], a["spec"])
        opens = (n == 1) & a["head"]
        return F.when(opens, F.struct(a["text"].alias("own"), F.lit(None).cast("string").alias("label"), F.lit(None).cast("string").alias("value"))).when(n >= 2, F.struct(group.alias("own"), label.alias("label"), b["text"].alias("value")))

    rows = found.select(key, "position", "heading", let(F.col("cells"), read).alias("y")).filter("y IS NOT NULL").select(key, "position", "heading", "y.*")
    return carry_section(rows, key).filter("label IS NOT NULL").select(key, "position", "section", "label", "value")


def carry_section(rows: DataFrame, key: str, position: str = "position", own: str = "own", heading: str = "heading") -> DataFrame:
    """``section``: the last group label at or before a row of the same page and heading, else the heading."""
    w = Window.partitionBy(key, heading).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("section", F.coalesce(F.last(F.nullif(F.col(own), F.lit("")), ignorenulls=True).over(w), F.col(heading)))


def canonical_label(label: Column) -> Column:
    """Lower case, without punctuation and without filler words at the end."""
    t = F.lower(clean_text(label))
    t = F.regexp_replace(t, r"[^a-z0-9 .-]", "")
    return F.trim(F.regexp_replace(t, r"\b(?:is|which|that|are|the)\b.*$", ""))


def label_aliases(rows: DataFrame, aliases: DataFrame, label: str = "label") -> DataFrame:
    """``canonical``: the name in ``aliases(alias, name)`` of the longest run of a label's first words that is there, or the label's own canonical form.

    The rows are written once, as they are read for their distinct labels and again to be named.
    """
    rows = saved(rows, "labels")
    each = rows.select(F.col(label).alias("__raw")).distinct().withColumn("__own", canonical_label(F.col("__raw")))
    words = F.split("__own", " ")
    starts = F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.concat_ws(" ", F.slice(words, F.lit(1), i)))
    found = each.select("__raw", "__own", F.explode(starts).alias("alias")).join(aliases.select("alias", "name"), "alias", "left")
    found = found.groupBy("__raw", "__own").agg(F.max_by("name", F.when(F.col("name").isNotNull(), F.length("alias"))).alias("__n"))
    return rows.join(found, rows[label].eqNullSafe(F.col("__raw")), "left").withColumn("canonical", F.coalesce("__n", "__own")).drop("__n", "__own", "__raw")


def raw_record(rows: DataFrame, key: str) -> DataFrame:
    """key, record: the rows of a page as JSON, section by section, label by label; of a label's values the first by position counts."""
    first = rows.groupBy(key, "section", "label").agg(F.min_by("value", "position").alias("value"), F.min("position").alias("p"))
    entry = lambda k, v: F.transform(F.array_sort(F.collect_list(F.struct("p", k, v))), lambda x: F.struct(x[k], x[v]))
    parts = first.groupBy(key, F.coalesce("section", F.lit("")).alias("section")).agg(F.map_from_entries(entry("label", "value")).alias("facts"), F.min("p").alias("p"), F.to_json(F.map_from_entries(entry("label", "value"))).alias("j"))
    whole = F.transform(F.array_sort(F.collect_list(F.struct("p", "section", "j"))), lambda x: F.concat(F.to_json(F.struct(x["section"].alias("s"))), F.lit("\0"), x["j"]))
    # {"s":"name"} and the section's object become "name":{...}
    member = lambda x: F.concat(F.regexp_extract(x, r'(?s)^\{"s":(".*")\}\x00', 1), F.lit(":"), F.regexp_extract(x, r"(?s)\x00(.*)$", 1))
    return parts.groupBy(key).agg(F.concat(F.lit("{"), F.concat_ws(",", F.transform(whole, member)), F.lit("}")).alias("record"))


def pivot_specs(rows: DataFrame, key: str, labels: list[str], label: str = "canonical", value: str = "value") -> DataFrame:
    """One row for each page with a column for each label; of several values the first by position."""
    first = {x: F.min_by(F.when(F.col(label) == x, F.col(value)), F.when(F.col(label) == x, F.col("position"))).alias(x) for x in labels}
    return rows.groupBy(key).agg(*first.values())


def json_ld(html: Column) -> Column:
    """struct(name, description, price) of the embedded product, wherever it stands in the page's embedded data."""
    item = embedded_product(html)
    return F.when(item["found"], F.struct(item["name"].alias("name"), item["description"].alias("description"), number_value(item["price"], None).alias("price")))


def page_price(html: Column) -> Column:
    """The first that a page has: embedded product data, a script's price field, a price element, a text with Rs or PKR."""
    def first(pattern: str) -> Column:
        return number_value(F.nullif(F.regexp_extract(html, pattern, 1), F.lit("")), None)

    return F.coalesce(
        json_ld(html)["price"], first(r'(?i)"(?:sale)?price"\s*:\s*"?([\d.,]+)'), first(r'(?is)<[^>]*class="[^"]*\bprice\b[^"]*"[^>]*>\D{0,20}([\d][\d.,]*)'), first(r"(?i)(?:Rs\.?|PKR)\s*([\d][\d,]*(?:\.\d+)?)"))


#: Kinds of screen as sellers name them; where several begin at one place the longest counts.
PANELS = ("Super AMOLED", "Dynamic AMOLED", "AMOLED", "OLED", "IPS LCD", "PLS TFT", "LTPS", "LCD", "TFT")


def text_fallbacks(spec: dict[str, Column], text: Column) -> dict[str, Column]:
    """Values from free text where the specification has none: ram and storage in GB, screen in inches, screen_kind, resolution as ``WxH``, os."""
    def first(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))

    kinds = "|".join(x.replace(" ", r"\s+") for x in PANELS)
    named = F.regexp_replace(F.lower(first(rf"(?i)\b({kinds})")), r"\s+", " ")
    sides = F.regexp_extract(text, r"(?i)(?<!\d)(\d{3,5})\s*[x×]\s*(\d{3,5})(?!\d)", 0)
    found = {
        "ram": first(r"(?i)\b(\d{1,2})\s*GB\s*RAM"), "storage": first(r"(?i)\b(\d{2,4})\s*GB\s*(?:ROM|storage|memory)"), "screen": first(r'(?i)\b(\d(?:\.\d+)?)\s*(?:inch|")'), "os": first(r"(?i)\b(android(?:\s*\d+)?|ios(?:\s*\d+)?)"),
        "screen_kind": F.coalesce(*(F.when(named == x.lower(), x) for x in PANELS)), "resolution": F.nullif(F.regexp_replace(F.lower(sides), r"\s*[x×]\s*", "x"), F.lit("")),
    }
    return {k: F.coalesce(spec.get(k, F.lit(None).cast("string")), v) for k, v in found.items()}


def title(html: Column) -> Column:
    return F.nullif(clean_text(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))


def first_heading(html: Column) -> Column:
    return F.nullif(clean_text(F.regexp_replace(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1), "<[^>]+>", " ")), F.lit(""))
