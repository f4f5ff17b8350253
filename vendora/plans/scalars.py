"""Scalar-function queries: texts are built from the given tables, the SQL states the values that they were built from."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as s
from ..operators import pages
from ..operators.finalise import evidence, finalise, raw_schema, spread, step
from .registry import query, table


def _text(*parts):
    return F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts))


def _pick(values, key="p_partkey"):
    """One of some texts, by the row's key."""
    return F.element_at(F.array(*(F.lit(v).cast("string") for v in values)), (F.col(key) % len(values) + 1).cast("int"))


def _picked(values, key="p_partkey"):
    """The same in SQL."""
    shown = ("NULL" if v is None else str(v) if not isinstance(v, str) else "'" + v.replace("'", "''") + "'" for v in values)
    return f"list_extract([{', '.join(shown)}], {key} % {len(values)} + 1)"


def _part(spark, d):
    p = table(spark, d, "part")
    return p.withColumn("k", F.col("p_partkey")).withColumn("n", F.col("p_size")).withColumn("t", F.col("p_size").cast("string"))


@query("""SELECT p_partkey AS k, (100 + p_size)::DOUBLE AS a, p_size::DOUBLE AS b, 7.5::DOUBLE AS c, (150 + p_size)::DOUBLE AS grams, (4000 + p_size)::INTEGER AS mah, 4.0::DOUBLE AS nm, (60 + p_size)::DOUBLE AS hz, (500 + p_size)::DOUBLE AS nits,
  CASE p_size % 4 WHEN 0 THEN 'AMOLED' WHEN 1 THEN 'OLED' WHEN 2 THEN 'LCD' ELSE 'LED' END AS screen, (1000 + p_size)::INTEGER AS width, (2000 + p_size)::INTEGER AS height, '20:9' AS ratio, (400 + p_size)::DOUBLE AS ppi FROM part""")
def units_parse(spark, d):
    n = F.col("n")
    r = s.resolution(_text((n + 1000).cast("string"), " x ", (n + 2000).cast("string"), " pixels, 20:9 ratio (~", (n + 400).cast("string"), " ppi density)"))
    dims = _text((n + 100).cast("string"), " x ", F.col("t"), " × 7.5 mm (5.8 x 2.4 x 0.3 in)")
    screen = F.element_at(F.array(*map(F.lit, ["Super AMOLED, 120Hz", "P-OLED", "IPS LCD", "edge LED panel"])), (n % 4 + 1).cast("int"))
    return _part(spark, d).select(
        "k", *(s.dimension(dims, i + 1).alias(c) for i, c in enumerate("abc")), s.weight_grams(_text((n + 150).cast("string"), " g (6.03 oz)")).alias("grams"), s.capacity_mah(_text("Li-Po 4,", F.lpad("t", 3, "0"), " mAh")).alias("mah"),
        s.chipset_nm(_text("Chip 8 Gen (4 nm)")).alias("nm"), s.hertz(_text("AMOLED, ", (n + 60).cast("string"), "Hz")).alias("hz"), s.nits(_text((n + 500).cast("string"), " nits (peak)")).alias("nits"),
        s.display_technology(screen).alias("screen"), r["width"].alias("width"), r["height"].alias("height"), r["ratio"].alias("ratio"), r["ppi"].alias("ppi"),
    )


@query("SELECT p_partkey AS k, CASE p_size % 3 WHEN 0 THEN '4:3' WHEN 1 THEN '16:9' END AS ratio FROM part")
def aspect_ratios(spark, d):
    n = F.col("n")
    w = F.when(n % 3 == 0, n * 4).when(n % 3 == 1, n * 16).otherwise(997)
    h = F.when(n % 3 == 0, n * 3).when(n % 3 == 1, n * 9).otherwise(1009)
    return _part(spark, d).select("k", s.aspect_ratio(w, h).alias("ratio"))


@query("""SELECT o_orderkey AS k, year(o_orderdate)::INTEGER AS year, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE upper(strftime(o_orderdate, '%b')) END AS month, CASE WHEN o_orderkey % 5 IN (2, 4) THEN NULL ELSE day(o_orderdate) END::INTEGER AS day FROM orders""")
def dates_parse(spark, d):
    """ISO, ``year, Month day``, ``year, Month``, a date in the second text, and a year alone."""
    k, o = F.col("o_orderkey"), F.col("o_orderdate")
    f = lambda p: F.date_format(o, p)
    announced = F.when(k % 5 == 0, _text("Announced ", f("yyyy-MM-dd"))).when(k % 5 == 1, _text(f("yyyy"), ", ", f("MMMM"), " ", f("dd"))).when(k % 5 == 2, _text(f("yyyy"), ", ", f("MMMM"))).when(k % 5 == 4, _text("Exp. ", f("yyyy")))
    status = F.when(k % 5 == 3, _text("Available. Released ", f("yyyy"), ", ", f("MMM"), " ", f("dd"))).otherwise("Discontinued")
    r = s.release_date(announced, status)
    return table(spark, d, "orders").select(k.alias("k"), r["year"].alias("year"), r["month"].alias("month"), r["day"].alias("day"))


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 2 THEN 2026 ELSE year(o_orderdate) END::INTEGER AS year, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m') ELSE '01-02' END AS month_day, CASE o_orderkey % 3 WHEN 0 THEN 'announced' WHEN 1 THEN 'status' ELSE 'current_utc' END AS source FROM orders""")
def snapshot_dates(spark, d):
    """A full date, a date that does not exist with a month in the second text, and the fallback."""
    k, o = F.col("o_orderkey"), F.col("o_orderdate")
    f = lambda p: F.date_format(o, p)
    announced = F.when(k % 3 == 0, _text(f("yyyy"), ", ", f("MMMM"), " ", f("dd"))).when(k % 3 == 1, _text(f("yyyy"), ", February 31"))
    status = F.when(k % 3 == 1, _text("Released ", f("yyyy"), ", ", f("MMMM"))).otherwise("Coming soon")
    r = s.snapshot_date(announced, status, F.lit("2026-01-02").cast("timestamp"))
    return table(spark, d, "orders").select(k.alias("k"), r["year"].alias("year"), r["month_day"].alias("month_day"), r["source"].alias("source"))


@query("SELECT p_partkey AS k, '128/' || p_size || ';1024/' || (p_size + 4) AS variants FROM part")
def memory_variants(spark, d):
    items = F.array(_text("128GB ", F.col("t"), "GB RAM"), _text("1TB ", (F.col("n") + 4).cast("string"), "GB RAM"), F.lit("no card"))
    return _part(spark, d).select("k", F.concat_ws(";", F.transform(s.memory_variants(items), lambda x: F.concat(x[0].cast("string"), F.lit("/"), x[1].cast("string")))).alias("variants"))


@query("SELECT p_partkey AS k, CASE p_size % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN false ELSE true END AS flag, CASE p_size % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS yes_no, p_size % 2 = 1 OR p_size % 5 = 0 AS int_flag FROM part")
def flags_parse(spark, d):
    n = F.col("n")
    word = F.element_at(F.array(*map(F.lit, [" Yes", "OFF", "unsupported", "maybe"])), (n % 4 + 1).cast("int"))
    answer = F.element_at(F.array(*map(F.lit, ["Yes, v5", "No, thanks", "perhaps"])), (n % 3 + 1).cast("int"))
    return _part(spark, d).select("k", s.bool_value(word, True).alias("flag"), s.yes_no(answer).alias("yes_no"), s.int_flag(F.when(n % 5 != 0, (n % 2).cast("string")), True).alias("int_flag"))


@query("SELECT p_partkey AS k, p_size || '.5' AS a, p_size * 1000 AS b, 7 AS c, CASE WHEN p_size % 2 = 0 THEN p_size ELSE p_size + 1 END AS even FROM part")
def numbers_parse(spark, d):
    """A plain number, one with commas in a text, a default, and half-even rounding."""
    n = F.col("n")
    return _part(spark, d).select(
        "k", s.number_value(_text(F.col("t"), ".5")).cast("string").alias("a"), s.number_value(_text("about ", F.format_number(n * 1000, 0), " units")).cast("int").alias("b"), s.int_value(F.lit("none"), 7).alias("c"), s.int_value(_text(F.col("t"), ".5")).alias("even"))


@query("SELECT p_partkey AS k, p_size || '|' || (p_size + 100) AS prices, (p_size + 155) || '|206.8|48000' AS numbers FROM part")
def prices_parse(spark, d):
    show = lambda a: F.concat_ws("|", F.transform(a, lambda x: F.regexp_replace(x.cast("string"), r"\.0$", "")))
    items = F.array(F.col("t"), F.lit("-1"), F.lit("no price"), _text("Rs. ", (F.col("n") + 100).cast("string")))
    text = _text("$ ", (F.col("n") + 155).cast("string"), " / € 206.80 / Rs. 48,000")
    return _part(spark, d).select("k", show(s.positive_prices(items)).alias("prices"), show(s.price_numbers(text)).alias("numbers"))


@query("SELECT p_partkey AS k, CASE WHEN p_size % 3 = 0 THEN p_type ELSE p_name END AS filled FROM part")
def fill_missing(spark, d):
    a = F.when(F.col("n") % 6 == 0, "N/A").when(F.col("n") % 3 != 0, F.col("p_name"))
    return _part(spark, d).select("k", s.fill_missing(a, F.col("p_type")).alias("filled"))


@query("SELECT l_orderkey AS k, l_linenumber AS position, CASE l_linenumber WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' ELSE 'PKR' END AS currency FROM lineitem")
def currency_by_position(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("position"), s.currency_at(F.col("l_linenumber")).alias("currency"))


@query("SELECT p_partkey AS k, string_split(p_name, ' ')[1] || '+' || p_type || '+x' AS items, '{\"' || p_name || '\",\"a\\\"b\"}' AS literal, p_name || '+a\"b' AS parsed FROM part")
def list_split(spark, d):
    literal = s.text_array(F.array(F.col("p_name"), F.lit(" "), F.lit('a"b'), F.lit(None).cast("string")))
    text = _text(F.get(F.split("p_name", " "), F.lit(0)), " , ", F.col("p_type"), ";;x /")
    return _part(spark, d).select("k", F.concat_ws("+", s.split_list(text)).alias("items"), literal.alias("literal"), F.concat_ws("+", s.parse_text_array(literal)).alias("parsed"))


@query("SELECT p_partkey AS k, '4K@24fps,4K@' || p_size || 'fps,1080p@60fps,gyro' AS modes FROM part")
def video_modes(spark, d):
    return _part(spark, d).select("k", F.concat_ws(",", s.video_modes(_text("4K@24/", F.col("t"), "fps, 1080p@60fps (stable), gyro"))).alias("modes"))


@query("SELECT event_id AS k, CAST(props->>'k' AS INTEGER) AS v, 7 AS missing FROM events")
def json_paths(spark, d):
    return table(spark, d, "events").select(F.col("event_id").alias("k"), F.get_json_object("props", "$.k").cast("int").alias("v"), F.coalesce(F.get_json_object("props", "$.none").cast("int"), F.lit(7)).alias("missing"))


@query("SELECT p_partkey AS k, CASE p_size % 3 WHEN 0 THEN 'Samsung' WHEN 1 THEN 'OnePlus' END AS company, CASE p_size % 3 WHEN 2 THEN 'Zed ' || p_name ELSE p_name END AS model, CASE p_size % 3 WHEN 0 THEN 'Samsung ' || p_name WHEN 1 THEN 'OnePlus ' || p_name ELSE 'Zed ' || p_name END AS display FROM part")
def brand_split(spark, d):
    n = F.col("n")
    raw = _text(F.when(n % 3 == 0, "SAMSUNG  ").when(n % 3 == 1, "one plus ").otherwise("Zed "), F.col("p_name"))
    b = s.split_brand(raw)
    company = F.coalesce(b["company"], F.lit("Zed"))
    return _part(spark, d).select("k", b["company"].alias("company"), b["model"].alias("model"), s.display_name(company, b["model"]).alias("display"))


@query("""SELECT p_partkey AS k, p_brand AS company, (100 + p_size)::DOUBLE AS length_mm, (4000 + p_size)::INTEGER AS mah, 'LCD' AS screen, '720:1600' AS wh, true AS nano, false AS esim, 'IP68' AS ip, p_size % 2 = 0 AS usb_c, (2000 + p_size % 20)::INTEGER AS year FROM part""")
def evidence_record(spark, d):
    """A raw record turned into typed values by the text rules alone."""
    n = F.col("n")
    raw = F.struct(
        F.struct(_text((n % 20 + 2000).cast("string"), ", July").alias("Announced")).alias("Launch"), F.struct(_text((n + 100).cast("string"), " x 60 x 9 mm").alias("Dimensions"), F.lit("Nano-SIM").alias("SIM"), F.lit("IP68 dust/water resistant").alias("Protection")).alias("Body"),
        F.struct(F.lit("PLS IPS").alias("Type"), F.lit("720 x 1600 pixels, 20:9 ratio").alias("Resolution")).alias("Display"), F.struct(_text((n + 4000).cast("string"), " mAh").alias("Capacity")).alias("Battery"),
        F.struct(F.when(n % 2 == 0, "USB Type-C 2.0").otherwise("microUSB 2.0").alias("USB")).alias("Features"))
    p, e = evidence(spread(_part(spark, d), "k"), F.from_json(F.to_json(raw), raw_schema()))
    p, released = step(p, "released", {"date": s.release_date(e["Announced",], e["Status",])})
    return p.select(
        "k", F.col("p_brand").alias("company"), e["Body", "Dimensions", "DimensionA"].cast("double").alias("length_mm"), e["Battery", "Capacity"].cast("int").alias("mah"), e["Display", "Screen"].alias("screen"),
        F.concat_ws(":", e["Display", "ResolutionA"], e["Display", "ResolutionB"]).alias("wh"), (e["Body", "Nano-SIM"] == "1").alias("nano"), (e["Body", "E-SIM"] == "1").alias("esim"), e["Body", "Resistance-Standard"].alias("ip"),
        (e["Features", "USB-C"] == "1").alias("usb_c"), released["date"]["year"].alias("year"),
    )


#: Leaves of a raw record in their JSON types, and what is to be read: weight, capacity, 5G, 2G, NFC, memory.
LEAVES = (
    ('{"Body":{"Weight":190},"Battery":{"Capacity":5000},"Network":{"5G":1,"2G":0},"Features":{"NFC":1},"Memory":{"Types":[[128,8],["256","8"]]}}', 190.0, 5000, 1, 0, 1, "[[128,8],[256,8]]"),
    ('{"Body":{"Weight":"190"},"Battery":{"Capacity":"5000"},"Network":{"5G":"1","2G":"0"},"Features":{"NFC":"maybe"},"Memory":{"Types":["64GB"]}}', None, None, None, None, None, None),
    ('{"Body":{"Weight":"6.5 oz"},"Battery":{"Capacity":"5,000 mAh"},"Network":{"5G":"Yes, SA","2G":"no"},"Features":{"NFC":true},"Memory":{"Types":["128GB Built-in","8GB RAM (+8GB of Extended RAM)"]}}', 184.272, 5000, 1, 0, 1, "[[128,8]]"),
    ('{"Body":{"Weight":190.25},"Battery":{"Capacity":4999.9},"Network":{"5G":false,"2G":2.5},"Features":{"NFC":null},"Memory":{"Types":["64 GB","128 GB","4 GB RAM","6GB RAM"]}}', 190.25, 4999, 0, 1, None, "[[64,4],[128,6]]"),
    ('{"Body":{"Weight":[190]},"Battery":{"Capacity":{"mah":5000}},"Network":7,"Features":[],"Memory":{"Types":"8GB 256GB"}}', None, None, None, None, None, "[[8,256]]"),
    ('{"Body":{},"MobileName":7}', None, None, None, None, None, None),
)


@query(f"""SELECT p_partkey AS k, {_picked([x[1] for x in LEAVES])}::DOUBLE AS grams, {_picked([x[2] for x in LEAVES])}::INTEGER AS mah, {_picked([x[3] for x in LEAVES])}::INTEGER AS g5, {_picked([x[4] for x in LEAVES])}::INTEGER AS g2,
  {_picked([x[5] for x in LEAVES])}::INTEGER AS nfc, {_picked([x[6] for x in LEAVES])} AS memory FROM part""")
def raw_leaves(spark, d):
    """Numbers, flags, texts and lists in raw records: numbers count as they are, texts only with a unit or a word."""
    p, e = evidence(spread(table(spark, d, "part"), "p_partkey"), F.from_json(_pick([x[0] for x in LEAVES]), raw_schema()))
    return p.select(
        F.col("p_partkey").alias("k"), e["Body", "Weight"].cast("double").alias("grams"), e["Battery", "Capacity"].cast("int").alias("mah"), e["Network", "5G"].cast("int").alias("g5"), e["Network", "2G"].cast("int").alias("g2"),
        e["Features", "NFC"].cast("int").alias("nfc"), e["Memory", "Types"].alias("memory"))


#: Titles and descriptions, and what is to be read: ram, storage, screen, kind, resolution, os.
ADVERTS = (
    ("Phone X 8GB RAM 256GB ROM 6.7 inch Super  AMOLED 1080 x 2400 Android 14", "8", "256", "6.7", "Super AMOLED", "1080x2400", "Android 14"),
    ('4 GB RAM / 64 GB storage, 6.5" IPS LCD (720×1600)', "4", "64", "6.5", "IPS LCD", "720x1600", None),
    ("dynamic amoled panel, iOS 17", None, None, None, "Dynamic AMOLED", None, "iOS 17"), ("tft and oled, 12 x 34 tiles", None, None, None, "TFT", None, None), ("nothing to read", None, None, None, None, None, None),
)


@query(f"SELECT p_partkey AS k, {', '.join(f'{_picked([x[i + 1] for x in ADVERTS])}::VARCHAR AS {c}' for i, c in enumerate(('ram', 'storage', 'screen', 'screen_kind', 'resolution', 'os')))} FROM part")
def text_facts(spark, d):
    """Facts in free text."""
    found = pages.text_fallbacks({}, _pick([x[0] for x in ADVERTS]))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), *(c.alias(k) for k, c in found.items()))


#: Texts as sellers and catalogues write them, and what is to be read.
MEASURES = (
    ("161.4 x 78.1 x 9.4 mm, 6.03 oz, 59.94 Hz", 161.4, 170.948, 59.94), ("5.811 × 2.4 × 0.3 inches | 1,024g", 147.599, 1024.0, None), ("weighs 7 OZ; 120hz panel", None, 198.447, 120.0),
    ("no numbers", None, None, None), ("143 x 60 mm, 90 Hz / 60 Hz", None, None, 90.0), ("2x3x4in, 10 g (0.35 oz)", 50.8, 10.0, None),
)


@query(f"SELECT p_partkey AS k, {_picked([m[1] for m in MEASURES])}::DOUBLE AS length_mm, {_picked([m[2] for m in MEASURES])}::DOUBLE AS grams, {_picked([m[3] for m in MEASURES])}::DOUBLE AS hz FROM part")
def units_irregular(spark, d):
    """Units in texts that follow no template."""
    text = _pick([m[0] for m in MEASURES])
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), s.dimension(text, 1).alias("length_mm"), s.weight_grams(text).alias("grams"), s.hertz(text).alias("hz"))


SCREENS = (
    ("Dynamic LTPO AMOLED 2X", "720 x 1600 pixels, 20:9 ratio (~270 ppi density)", "AMOLED", "720:1600:20:9:270.0"), ("Foldable P-OLED", "2,640 x 1080 pixel", "OLED", "2640:1080::"), ("PLS IPS", "1080 × 2340 Pixels, 19.5 : 9", "LCD", "1080:2340:19.5:9:"),
    ("edge-LED panel", "5 x 900 pixels", "LED", None), ("TFT", "big", "LCD", None), ("paper", "1080 x 2340", None, None), ("old CRT", "320x240pixels ~ 140.5ppi", "CRT", "320:240::140.5"),
)


@query(f"SELECT p_partkey AS k, {_picked([x[2] for x in SCREENS])} AS kind, {_picked([x[3] for x in SCREENS])} AS grid FROM part")
def screens_irregular(spark, d):
    kind, grid = _pick([x[0] for x in SCREENS]), s.resolution(_pick([x[1] for x in SCREENS]))
    shown = F.concat_ws(":", *(F.coalesce(grid[c].cast("string"), F.lit("")) for c in ("width", "height", "ratio", "ppi")))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), s.display_technology(kind).alias("kind"), F.when(grid.isNotNull(), shown).alias("grid"))


MEMORY = (
    ("3 GB 16/32 GB", "16/3;32/3"), ("6GB RAM / 128GB, 256GB", "128/6;256/6"), ("128GB 8GB RAM", "128/8"), ("1TB 16GB RAM", "1024/16"), ("64GB", ""), ("card slot", ""), ("8 GB 128/256/512 GB", "128/8;256/8;512/8"), ("4GB/64GB", "4/64"),
)


@query(f"SELECT p_partkey AS k, {_picked([x[1] for x in MEMORY])} AS variants FROM part")
def memory_notations(spark, d):
    pairs = s.memory_variants(F.array(_pick([x[0] for x in MEMORY])))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.concat_ws(";", F.transform(pairs, lambda x: F.concat(x[0].cast("string"), F.lit("/"), x[1].cast("string")))).alias("variants"))


CARDS = (("Nano-SIM and eSIM", "0/1/1"), ("Mini-SIM", "1/0/0"), ("Single SIM", "1/0/0"), ("e-SIM only", "0/0/1"), ("Nano + Micro-SIM", "1/1/0"), ("  ", None))
BODIES = (("IP69k rated", "IP69K/1/1"), ("Water repellent coating", "-/1/-"), ("dust and water resistant, no code", "-/1/1"), ("ip68 dust", "IP68/1/1"), ("glass front", "-/-/-"))
PORTS = (("USB Type-C 3.2", "0/1"), ("microUSB 2.0", "1/0"), ("USB-C", "0/1"), ("Lightning", None))


@query(f"SELECT p_partkey AS k, {_picked([x[1] for x in CARDS])} AS sim, {_picked([x[1] for x in BODIES])} AS body, {_picked([x[1] for x in PORTS])} AS usb FROM part")
def feature_flags(spark, d):
    """Card, resistance and port facts of free texts."""
    show = lambda c, *names: F.concat_ws("/", *(F.coalesce(c[n].cast("string"), F.lit("-")) for n in names))
    sim, body, usb = s.sim_flags(_pick([x[0] for x in CARDS])), s.resistance(_pick([x[0] for x in BODIES])), s.usb_flags(_pick([x[0] for x in PORTS]))
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("k"), F.when(sim.isNotNull(), show(sim, "normal", "nano", "esim")).alias("sim"), show(body, "standard", "water", "dust").alias("body"), F.when(usb.isNotNull(), show(usb, "micro", "usb_c")).alias("usb"))


FLAGS = (("2", True), ("0.0", False), ("-1", True), ("maybe", None), (" ON ", True), ("none", False), ("", None), ("unsupported", False))
BLANKS = ((" n/a ", None), ("Unknown", None), ("0", "0"), ("NULL", None), ("value", "value"), ("None", None))


@query(f"SELECT p_partkey AS k, coalesce({_picked([x[1] for x in FLAGS])}, p_size > 25) AS flag, coalesce({_picked([x[1] for x in BLANKS])}, p_type) AS filled FROM part")
def values_irregular(spark, d):
    """Flags with numbers and unknown words, and texts that stand for nothing."""
    flag = F.when(F.col("p_size") > 25, s.bool_value(_pick([x[0] for x in FLAGS]), True)).otherwise(s.bool_value(_pick([x[0] for x in FLAGS]), False))
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), flag.alias("flag"), s.fill_missing(_pick([x[0] for x in BLANKS]), F.col("p_type")).alias("filled"))


@query(f"""WITH b(spelling, brand) AS (VALUES {', '.join(f"('{k}', '{v}')" for k, v in s.BRANDS.items())})
SELECT p_partkey AS k, spelling, brand AS company, p_name AS model FROM part CROSS JOIN b WHERE p_partkey % {len(s.BRANDS)} = (SELECT count(*) FROM b c WHERE c.spelling < b.spelling)
UNION ALL SELECT p_partkey, 'other', 'ZEdd Über', p_name FROM part""")
def brand_table(spark, d):
    """Each part under one of the brands, in changed letters and blanks, and under an unknown one."""
    spelling = _pick(sorted(s.BRANDS))
    p = table(spark, d, "part").select(F.col("p_partkey").alias("k"), "p_name", spelling.alias("spelling"))
    raw = F.concat(F.lit("  "), F.when(F.col("k") % 2 == 0, F.upper("spelling")).otherwise(F.initcap("spelling")), F.lit("  "), F.col("p_name"))
    known = p.select("k", "spelling", s.split_brand(raw).alias("b")).select("k", "spelling", "b.company", "b.model")
    return known.unionByName(p.select("k", F.lit("other").alias("spelling"), s.canonical_brand(F.lit(" zEdd  über")).alias("company"), F.col("p_name").alias("model")))


@query("SELECT p_partkey AS k, CASE WHEN p_size > 0 THEN 1 ELSE 0 END AS by_number, CASE p_size % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS by_word FROM part")
def binary_indicators(spark, d):
    """A column that is four fifths numbers, and one of words, each judged on the whole table."""
    n = F.col("p_size")
    p = table(spark, d, "part").select(F.col("p_partkey").alias("k"), n.cast("string").alias("number"), F.element_at(F.array(*map(F.lit, [" Yes", "false", "other"])), (n % 3 + 1).cast("int")).alias("word"))
    whole = p.agg(s.binary_shares(F.col("number")).alias("n"), s.binary_shares(F.col("word")).alias("w"))
    p = p.crossJoin(F.broadcast(whole))  # one row
    return p.select("k", s.binary_indicator(F.col("number"), F.col("n")).alias("by_number"), s.binary_indicator(F.col("word"), F.col("w")).alias("by_word"))


def _records(spark, d):
    """Part rows as a filled record with gaps and the raw record that it came from."""
    n = F.col("p_size")
    raw = F.struct(
        F.concat(F.lit("SAMSUNG "), F.col("p_name")).alias("MobileName"), F.struct(F.when(n % 2 == 0, "2023, March 09").alias("Announced"), F.when(n % 2 == 1, "Available. Released 2021, June").alias("Status")).alias("Launch"),
        F.struct((n + 100).cast("string").alias("x"), F.concat((n + 100).cast("string"), F.lit(" x 60 x 9 mm")).alias("Dimensions"), F.lit("7 oz").alias("Weight"), F.lit("Nano-SIM + eSIM").alias("SIM"), F.lit("IP69k").alias("Protection")).alias("Body"),
        F.struct(F.lit("IPS LCD, 90Hz").alias("Type"), F.lit("1080 x 2160 pixels").alias("Resolution")).alias("Display"), F.struct(F.array(F.lit("4 GB 64/128 GB")).alias("Types")).alias("Memory"),
        F.struct(F.lit("USB Type-C 2.0").alias("USB"), F.lit("Yes, NFC").alias("NFC")).alias("Features"), F.struct(F.concat(n.cast("string"), F.lit(",000 mAh")).alias("Capacity")).alias("Battery"))
    record = F.struct(
        F.when(n % 3 == 0, "one plus").when(n % 3 == 1, "unknown").alias("CompanyName"), F.when(n % 3 == 0, F.concat(F.lit("OnePlus "), F.col("p_name"))).alias("MobileName"),
        F.struct(F.when(n % 4 == 0, "Plasma").when(n % 4 == 1, "OLED").alias("Screen"), F.when(n % 5 == 0, "144").alias("Refresh-Rate")).alias("Display"), F.struct(F.when(n % 7 == 0, "[]").otherwise("n/a").alias("Types")).alias("Memory"))
    return spread(table(spark, d, "part"), "p_partkey").select(F.col("p_partkey").alias("k"), F.to_json(record).alias("record"), F.to_json(raw).alias("raw"))


@query("""SELECT p_partkey AS k, CASE WHEN p_size % 3 = 0 THEN 'OnePlus' ELSE 'Samsung' END AS company, p_name AS model, CASE WHEN p_size % 2 = 0 THEN '2023-MAR-9' ELSE '2021-JUN-' END AS released, CASE WHEN p_size % 2 = 0 THEN '2023, March 09' ELSE 'Available. Released 2021, June' END AS status,
  (100 + p_size)::DOUBLE AS length_mm, 198.447::DOUBLE AS grams, 'IP69K' AS sealed, CASE p_size % 4 WHEN 0 THEN 'LCD' WHEN 1 THEN 'OLED' ELSE 'LCD' END AS screen, CASE WHEN p_size % 5 = 0 THEN 144 ELSE 90 END::DOUBLE AS hz, '1:2' AS ratio, '[[64,4],[128,4]]' AS memory, 1 AS usb_c, 0 AS micro, 1 AS nfc, 1 AS network_2g, (p_size * 1000)::DOUBLE AS mah, '[]' AS colors,
  CAST(round((CASE WHEN p_size % 3 = 2 THEN 1 ELSE 2 END + 17) * 100.0 / 28, 2) AS DOUBLE) - CAST(round(17 * 100.0 / 28, 2) AS DOUBLE) > 3 AS stored FROM part""")
def finalised_records(spark, d):
    """Finished records: own values, then what the raw texts say, then defaults."""
    from ..operators.catalog import stored_completeness
    from ..schema import paths
    from ..sources.records import payload_schema

    r = _records(spark, d).select("k", F.from_json("record", payload_schema()).alias("own"), F.from_json("raw", raw_schema()).alias("raw"))
    r = finalise(r, F.col("own"), F.col("raw"), F.lit("https://x.example/1"), paths(), "r")
    at = lambda *p: F.col("r").getField(p[0]) if len(p) == 1 else at(*p[:-1]).getField(p[-1])
    own = F.coalesce(stored_completeness(F.col("own")), F.lit(0))
    return r.select(
        "k", at("CompanyName").alias("company"), at("MobileName").alias("model"), F.concat(at("Year"), F.lit("-"), at("Month"), F.lit("-"), F.coalesce(at("Day"), F.lit(""))).alias("released"), at("Status").alias("status"), at("Body", "Dimensions", "DimensionA").cast("double").alias("length_mm"),
        at("Body", "Weight").cast("double").alias("grams"), at("Body", "Resistance-Standard").alias("sealed"), at("Display", "Screen").alias("screen"), at("Display", "Refresh-Rate").cast("double").alias("hz"), at("Display", "Ratio").alias("ratio"), at("Memory", "Types").alias("memory"),
        at("Features", "USB-C").cast("int").alias("usb_c"), at("Features", "Micro-USB").cast("int").alias("micro"), at("Features", "NFC").cast("int").alias("nfc"), at("Network", "2G").cast("int").alias("network_2g"), at("Battery", "Capacity").cast("double").alias("mah"), at("Colors").alias("colors"), (own > 3).alias("stored"),
    )
