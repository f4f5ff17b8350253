"""From a raw page record and a partly filled one to a finished record: facts read from the texts, gaps filled, values clamped, defaults set.

The work is done in steps, each a projection whose values are columns of their own: what later rules use many times (a leaf's
text, a name, a date) is computed once for each row. As one expression, every use would hold a copy of all that it is made of.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, VariantType

from ..functions import scalars as s
from ..schema import HEADER, RELEASE, SECTIONS
from ..sources.records import leaf, text_list

# Leaves of a raw record.
RAW = {
    "MobileName": None, "Launch": ("Announced", "Status"), "Network": ("2G", "3G", "4G", "5G"), "Body": ("Dimensions", "Weight", "Build", "SIM", "Protection"), "Display": ("Type", "Size", "Resolution", "Protection"),
    "Platform": ("OS", "Chipset", "CPU", "GPU"), "Memory": ("Card slot", "Types", "Technology"), "Main Camera": ("Specifications", "Features", "Video"), "Selfie Camera": ("Specifications", "Video"), "Sound": ("Loudspeaker", "3.5mm jack"),
    "Features": ("WLAN", "Bluetooth", "Positioning", "NFC", "Infrared port", "Radio", "USB", "BackFingerPrint", "SideFingerPrint", "InDisplayFingerPrint"), "Battery": ("Capacity", "WirelessCharging", "Charging"), "Colors": None, "Price": None,
}
# Kinds of screen that a record may name.
SCREENS = ("CRT", "LCD", "LED", "AMOLED", "OLED")
Facts = dict[tuple[str, ...], Column]


def raw_schema() -> StructType:
    """A raw record for ``from_json``: every leaf keeps its JSON type, so that the number 190 and the text "190" differ."""
    v = VariantType()
    return StructType([StructField(k, v if x is None else StructType([StructField(y, v) for y in x])) for k, x in RAW.items()])


def _kind(v: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def number_of(v: Column, kind: Column | None = None) -> Column:
    """The value of a leaf that is a JSON number, or 0 or 1 of a flag; null for all else, a text of digits included."""
    kind = _kind(v) if kind is None else kind
    number = F.when(kind.isin("BIGINT", "DOUBLE", "DECIMAL", "FLOAT"), F.try_variant_get(v, "$", "double"))
    return F.coalesce(number, F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("double")))


def answer_of(v: Column, kind: Column | None = None) -> Column:
    """0 or 1: a number is 1 unless it is 0, a text counts by its words."""
    kind = _kind(v) if kind is None else kind
    return F.coalesce((number_of(v, kind) != 0).cast("int"), F.when(kind == "STRING", s.yes_no(F.try_variant_get(v, "$", "string"))))


def step(df: DataFrame, name: str, values: dict) -> tuple[DataFrame, dict]:
    """``df`` with the values as columns ``__<name><number>``, and those columns under the same keys."""
    names = {k: f"__{name}{i}" for i, k in enumerate(values)}
    return df.select("*", *(c.alias(names[k]) for k, c in values.items())), {k: F.col(n) for k, n in names.items()}


def spread(df: DataFrame, key: str) -> DataFrame:
    """The rows dealt over four tasks a core by their key, before work that is heavy for each row: a file of few bytes or row groups is read by few tasks, however many rows it has."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, key)


def evidence(df: DataFrame, raw: Column) -> tuple[DataFrame, Facts]:
    """What a raw record (of :func:`raw_schema`) says, by path in the finished record; null where it says nothing.

    Numbers are taken as they are where the finished record has one, only texts are searched for units and words; lists and
    objects stand as their JSON. The facts are columns of the returned table, which has those of ``df`` and of the steps too.
    The work is done in the tasks of ``df``, which :func:`spread` deals over all cores.
    """
    df, record = step(df, "raw", {"raw": raw})
    value = {(k, *x): leaf(record["raw"], (k, *x)) for k, parts in RAW.items() for x in ([()] if parts is None else [(y,) for y in parts])}
    df, kind = step(df, "kind", {p: _kind(v) for p, v in value.items()})
    df, text = step(df, "text", {p: F.try_variant_get(v, "$", "string") for p, v in value.items()})
    at = lambda *path: text[path]
    said = lambda *path: F.when(kind[path] == "STRING", text[path])
    number = lambda *path: number_of(value[path], kind[path])
    screen = [at("Display", x) for x in ("Type", "Size", "Resolution")]
    df, read = step(df, "read", {
        "name": s.split_brand(said("MobileName")), "sim": s.sim_flags(at("Body", "SIM")), "grid": s.resolution(at("Display", "Resolution")), "usb": s.usb_flags(at("Features", "USB")),
        "sealed": s.resistance(F.concat_ws(" ", at("Body", "Protection"), at("Body", "Build"))), "size": s.measures(at("Body", "Dimensions"), "length", 3),
        "variants": s.memory_variants(F.coalesce(text_list(at("Memory", "Types")), F.array().cast("array<string>")))})
    name, sim, grid, usb, sealed, variants = (read[x] for x in ("name", "sim", "grid", "usb", "sealed", "variants"))
    same = [(k, x) for k, parts in RAW.items() if parts for x in parts if (k, x) in {
        ("Body", "Build"), ("Display", "Protection"), ("Memory", "Card slot"), ("Memory", "Technology"), ("Battery", "Charging")} or (k in ("Platform", "Main Camera", "Selfie Camera")) or x in ("WLAN", "Bluetooth", "Positioning")]
    answers = [(k, x) for k in ("Network", "Sound") for x in RAW[k]] + [("Features", x) for x in RAW["Features"][3:] if x != "USB"] + [("Battery", "WirelessCharging")]
    out: Facts = {p: at(*p) for p in same} | {p: answer_of(value[p], kind[p]) for p in answers}
    out |= {("CompanyName",): name["company"], ("MobileName",): name["model"], ("Announced",): at("Launch", "Announced"), ("Status",): at("Launch", "Status"), ("Colors",): at("Colors"), ("Price",): at("Price")}
    out |= {("Body", "Dimensions", f"Dimension{c}"): F.get(read["size"], F.lit(i)) for i, c in enumerate("ABC")}
    out |= {("Body", "Weight"): F.coalesce(number("Body", "Weight"), s.weight_grams(said("Body", "Weight"))), ("Body", "Normal-SIM"): sim["normal"], ("Body", "Nano-SIM"): sim["nano"], ("Body", "E-SIM"): sim["esim"]}
    out |= {("Body", "Resistance-Standard"): sealed["standard"], ("Body", "Resistance-Water"): sealed["water"], ("Body", "Resistance-Dust"): sealed["dust"]}
    out |= {("Display", "Screen"): s.display_technology(at("Display", "Type")), ("Display", "ResolutionA"): grid["width"], ("Display", "ResolutionB"): grid["height"], ("Display", "Ratio"): grid["ratio"], ("Display", "Pixel-Density"): grid["ppi"]}
    out |= {("Display", "Refresh-Rate"): F.coalesce(*map(s.hertz, screen)), ("Display", "Brightness"): F.coalesce(*map(s.nits, screen)), ("Platform", "Chipset-Size"): s.chipset_nm(at("Platform", "Chipset"))}
    out |= {("Features", k): usb[c] for k, c in (("USB-A", "usb_a"), ("USB-B", "usb_b"), ("Micro-USB", "micro"), ("USB-C", "usb_c"))}
    out |= {("Memory", "Types"): F.when(F.size(variants) > 0, F.to_json(variants)), ("Battery", "Capacity"): F.coalesce(number("Battery", "Capacity").cast("long"), s.capacity_mah(said("Battery", "Capacity")))}
    return step(df, "fact", {p: c.cast("string") for p, c in out.items()})


def merge(record: Column, facts: Facts, paths: list[tuple[str, ...]]) -> Facts:
    """Every leaf of a record, from the facts where the record's own value stands for nothing."""
    empty = lambda c: F.when(F.trim(c) != "[]", c)
    return {p: s.fill_missing(empty(leaf(record, p)), facts[p]) if p in facts else leaf(record, p) for p in paths}


def finish(df: DataFrame, found: Facts, url: Column) -> tuple[DataFrame, Facts]:
    """Names, dates, enumerations, flags and numbers as a finished record has them."""
    df, named = step(df, "named", {p: F.nullif(s.clean_text(found[p,]), F.lit("")) for p in ("CompanyName", "MobileName")})
    types = F.from_json(found["Memory", "Types"], "array<array<int>>")
    df, read = step(df, "value", {
        "company": s.canonical_brand(named["CompanyName"]), "mobile": F.coalesce(named["MobileName"], F.lit("Unknown")), "announced": F.coalesce(found["Announced",], found["Status",]), "status": F.coalesce(found["Status",], found["Announced",]),
        "pairs": F.filter(types, lambda x: (F.size(x) == 2) & x[0].isNotNull() & x[1].isNotNull())} | {p: found[p].try_cast("double") for part in (HEADER, *SECTIONS.values()) for p, kind, _ in part.values() if kind in ("bool", "int", "number")})
    company, mobile, announced, status = (read[x] for x in ("company", "mobile", "announced", "status"))
    bare = F.when((company != "Unknown") & F.startswith(F.lower(mobile), F.concat(F.lower(company), F.lit(" "))), F.nullif(F.trim(F.substring(mobile, F.length(company) + 1, F.length(mobile))), F.lit(""))).otherwise(mobile)
    out: Facts = {("CompanyName",): company, ("MobileName",): F.coalesce(bare, F.lit("Unknown")), ("URL",): url, ("Price",): found["Price",]}
    for part in (HEADER, *SECTIONS.values()):
        for path, kind, default in part.values():
            c = found[path]
            if kind == "bool":
                c = F.coalesce((read[path] != 0).cast("int"), F.lit(int(default)))
            elif kind in ("int", "number"):
                c = F.coalesce(read[path], F.lit(default).cast("double"))
            elif kind == "list":
                c = F.when(F.startswith(F.trim(c), F.lit("[")), c).otherwise("[]")
            out[path] = c
    wide = {p: out["Display", p] for p in ("ResolutionA", "ResolutionB")}
    df, more = step(df, "more", {"released": s.release_date(announced, status)} | wide)
    released, w, h = more["released"], more["ResolutionA"], more["ResolutionB"]
    out |= {("Announced",): announced, ("Status",): status, ("Year",): F.coalesce(released["year"], F.lit(RELEASE["release_year"][2])), ("Month",): F.coalesce(released["month"], F.lit(RELEASE["release_month"][2])), ("Day",): released["day"]}
    screen = found["Display", "Screen"]
    out["Display", "Screen"] = F.when(screen.isin(*SCREENS), screen).otherwise(SECTIONS["display"]["screen_technology"][2])
    df, sides = step(df, "side", {p: more[p].cast("int") for p in wide})
    plain = float(SECTIONS["display"]["resolution_width"][2])
    out["Display", "Ratio"] = F.coalesce(found["Display", "Ratio"], F.when((w != plain) & (h != plain), s.aspect_ratio(sides["ResolutionA"], sides["ResolutionB"])))
    pairs = read["pairs"]
    out["Memory", "Types"] = F.when(F.size(pairs) > 0, F.to_json(pairs)).otherwise(SECTIONS["memory"]["storage_ram_variants"][2])
    return df, {p: c.cast("string") for p, c in out.items()}


def nest(facts: Facts) -> Column:
    """A struct with a field for each step of the paths."""
    tree: dict[str, Facts | Column] = {}
    for path, c in facts.items():
        if len(path) == 1:
            tree[path[0]] = c
        else:
            tree.setdefault(path[0], {})[path[1:]] = c
    return F.struct(*((nest(v) if isinstance(v, dict) else v).alias(k) for k, v in tree.items()))


def finalise(df: DataFrame, record: Column, raw: Column, url: Column, paths: list[tuple[str, ...]], out: str = "finished") -> DataFrame:
    """``df`` with the finished record as a struct: the record's own values first, what its raw record says second, defaults last."""
    columns = df.columns
    df, facts = evidence(df, raw)
    df, found = step(df, "found", merge(record, facts, paths))
    df, done = finish(df, found, url)
    return df.select(*columns, nest(done).alias(out))
