"""The relational model, declared once: columns, types, keys and where a record's values come from.

A specification section exists twice, as ``specs.spec_<name>`` by product and as ``listings.listing_<name>`` by
listing; both, their readers and their checks follow from :data:`SECTIONS`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Section -> column -> (path in the record, kind, default).
SECTIONS: dict[str, dict[str, tuple[tuple[str, ...], str, object]]] = {
    "network": {
        "supports_2g": (("Network", "2G"), "bool", True), "supports_3g": (("Network", "3G"), "bool", True),
        "supports_4g": (("Network", "4G"), "bool", False), "supports_5g": (("Network", "5G"), "bool", False),
    },
    "body": {
        "dim_length_mm": (("Body", "Dimensions", "DimensionA"), "number", 50.0), "dim_width_mm": (("Body", "Dimensions", "DimensionB"), "number", 50.0),
        "dim_depth_mm": (("Body", "Dimensions", "DimensionC"), "number", 5.0), "weight_grams": (("Body", "Weight"), "number", 25.0), "build_materials": (("Body", "Build"), "text", ""),
        "has_normal_sim": (("Body", "Normal-SIM"), "bool", False), "has_nano_sim": (("Body", "Nano-SIM"), "bool", True), "has_esim": (("Body", "E-SIM"), "bool", False),
        "ip_rating": (("Body", "Resistance-Standard"), "text", ""), "is_water_resistant": (("Body", "Resistance-Water"), "bool", False), "is_dust_resistant": (("Body", "Resistance-Dust"), "bool", True),
    },
    "display": {
        "screen_technology": (("Display", "Screen"), "text", "LCD"), "refresh_rate_hz": (("Display", "Refresh-Rate"), "int", 60), "peak_brightness_nits": (("Display", "Brightness"), "int", 60),
        "resolution_width": (("Display", "ResolutionA"), "int", 240), "resolution_height": (("Display", "ResolutionB"), "int", 240), "aspect_ratio": (("Display", "Ratio"), "text", ""),
        "pixel_density_ppi": (("Display", "Pixel-Density"), "int", None), "screen_protection": (("Display", "Protection"), "text", ""),
    },
    "platform": {
        "operating_system": (("Platform", "OS"), "text", ""), "chipset_name": (("Platform", "Chipset"), "text", ""), "chipset_node_nm": (("Platform", "Chipset-Size"), "int", None),
        "cpu_description": (("Platform", "CPU"), "text", ""), "gpu_name": (("Platform", "GPU"), "text", ""),
    },
    "memory": {"card_slot": (("Memory", "Card slot"), "text", ""), "storage_ram_variants": (("Memory", "Types"), "json", "[[0,0]]"), "technology": (("Memory", "Technology"), "text", "")},
    "camera_main": {"sensor_specs": (("Main Camera", "Specifications"), "list", None), "photo_features": (("Main Camera", "Features"), "text", ""), "video_modes": (("Main Camera", "Video"), "list", None)},
    "camera_selfie": {"sensor_specs": (("Selfie Camera", "Specifications"), "list", None), "video_modes": (("Selfie Camera", "Video"), "list", None)},
    "connectivity": {
        "wifi_standards": (("Features", "WLAN"), "text", ""), "bluetooth_version": (("Features", "Bluetooth"), "text", ""), "positioning_systems": (("Features", "Positioning"), "text", ""),
        "has_nfc": (("Features", "NFC"), "bool", False), "has_infrared": (("Features", "Infrared port"), "bool", False), "has_fm_radio": (("Features", "Radio"), "bool", True),
        "has_usb_a": (("Features", "USB-A"), "bool", False), "has_usb_b": (("Features", "USB-B"), "bool", False), "has_micro_usb": (("Features", "Micro-USB"), "bool", True), "has_usb_c": (("Features", "USB-C"), "bool", False),
        "has_fp_rear": (("Features", "BackFingerPrint"), "bool", False), "has_fp_side": (("Features", "SideFingerPrint"), "bool", False), "has_fp_under_display": (("Features", "InDisplayFingerPrint"), "bool", False),
    },
    "battery": {"capacity_mah": (("Battery", "Capacity"), "int", 0), "has_wireless_charging": (("Battery", "WirelessCharging"), "bool", False), "charging_specs": (("Battery", "Charging"), "list", None)},
}
#: Header columns that products and listings share, besides the release date.
HEADER = {
    "announced_text": (("Announced",), "text", ""), "status_text": (("Status",), "text", ""), "colors": (("Colors",), "list", None),
    "has_loudspeaker": (("Sound", "Loudspeaker"), "bool", True), "has_3_5mm_jack": (("Sound", "3.5mm jack"), "bool", True),
}
RELEASE = {"release_year": (("Year",), "int", 2014), "release_month": (("Month",), "text", "DEC"), "release_day": (("Day",), "int", None)}
#: The leaves that the stored procedure's completeness counts, and the number it divides by.
STORED_PATHS = (
    ("CompanyName",), ("MobileName",), ("Announced",), ("Status",), ("Body", "Weight"), ("Body", "Dimensions", "DimensionA"), ("Display", "Screen"), ("Display", "Refresh-Rate"), ("Display", "ResolutionA"), ("Platform", "OS"),
    ("Platform", "Chipset"), ("Platform", "CPU"), ("Platform", "GPU"), ("Memory", "Card slot"), ("Memory", "Types"), ("Main Camera", "Specifications"), ("Selfie Camera", "Specifications"), ("Battery", "Capacity"), ("Battery", "Charging"),
)
STORED_TOTAL = 28
IDENTITY_PATHS = (("CompanyName",), ("MobileName",), ("URL",), ("Price",))


def paths() -> list[tuple[str, ...]]:
    """Every leaf of a record, which is what completeness counts."""
    found = [*IDENTITY_PATHS, *(p for part in (HEADER, RELEASE, *SECTIONS.values()) for p, _, _ in part.values())]
    return list(dict.fromkeys(found))


@dataclass(frozen=True)
class Table:
    name: str
    columns: dict[str, str]
    key: str
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()
    not_null: tuple[str, ...] = field(default=())


_KIND = {"text": "string", "bool": "boolean", "int": "int", "number": "decimal(10,2)", "json": "string", "list": "array<string>"}


def _types(part: dict) -> dict[str, str]:
    return {c: _KIND[kind] for c, (_, kind, _) in part.items()}


def _catalogue() -> dict[str, Table]:
    stamp, text, ident = "timestamp", "string", "bigint"
    t = [
        Table("metadata.scrape_runs", {"run_id": ident, "source_domain": text, "started_at": stamp, "finished_at": stamp, "records_processed": "int", "records_succeeded": "int", "records_failed": "int", "run_status": text}, "run_id", not_null=("source_domain", "started_at", "records_processed", "run_status")),
        Table("catalog.companies", {"company_id": ident, "company_name": text, "company_slug": text, "created_at": stamp}, "company_id", (("company_slug",),), not_null=("company_name", "company_slug")),
        Table("catalog.products", {"product_id": ident, "company_id": ident, "mobile_name": text, "product_slug": text, "created_by_source": text, "created_at": stamp, "updated_at": stamp}, "product_id", (("product_slug",),), (("company_id", "catalog.companies", "company_id"),), ("company_id", "mobile_name", "product_slug", "created_by_source")),
        Table("catalog.product_aliases", {"alias_id": ident, "product_id": ident, "alias_name": text, "alias_slug": text, "source_domain": text, "created_at": stamp}, "alias_id", (("alias_slug",),), (("product_id", "catalog.products", "product_id"),), ("product_id", "alias_name", "alias_slug")),
        Table("specs.product_specs", {"product_id": ident, **_types(RELEASE), **_types(HEADER), "specs_source": text, "last_updated": stamp}, "product_id", (), (("product_id", "catalog.products", "product_id"),), ("release_year", "release_month", "specs_source")),
        *(Table(f"specs.spec_{n}", {"product_id": ident, **_types(s)}, "product_id", (), (("product_id", "specs.product_specs", "product_id"),)) for n, s in SECTIONS.items()),
        Table("listings.market_listings", {"listing_id": ident, "product_id": ident, "instance_number": "int", "source_domain": text, "source_url": text, "listing_title": text, **_types(RELEASE), **_types(HEADER), "raw_payload": text, "scrape_run_id": ident, "scraped_at": stamp},
              "listing_id", (("source_url",), ("product_id", "source_domain", "instance_number")), (("product_id", "catalog.products", "product_id"), ("scrape_run_id", "metadata.scrape_runs", "run_id")), ("product_id", "instance_number", "source_domain", "source_url", "listing_title")),
        Table("listings.listing_prices", {"price_entry_id": ident, "listing_id": ident, "currency_code": text, "amount": "decimal(14,2)", "price_index": "int", "created_at": stamp}, "price_entry_id", (("listing_id", "currency_code", "price_index"),), (("listing_id", "listings.market_listings", "listing_id"),), ("listing_id", "currency_code", "amount")),
        *(Table(f"listings.listing_{n}", {"listing_id": ident, **_types(s)}, "listing_id", (), (("listing_id", "listings.market_listings", "listing_id"),)) for n, s in SECTIONS.items()),
        Table("metadata.data_quality", {"score_id": ident, "product_id": ident, "listing_id": ident, "source_domain": text, "completeness_pct": "decimal(5,2)", "fields_populated": "int", "fields_total": "int", "scored_at": stamp}, "score_id", (), (("product_id", "catalog.products", "product_id"), ("listing_id", "listings.market_listings", "listing_id")), ("source_domain", "fields_populated")),
        Table("metadata.etl_rejects", {"reject_id": ident, "scrape_run_id": ident, "source_domain": text, "source_url": text, "source_file": text, "reject_reason": text, "reject_detail": text, "raw_payload": text, "rejected_at": stamp, "resolved_at": stamp, "resolution_detail": text}, "reject_id", (), (("scrape_run_id", "metadata.scrape_runs", "run_id"),), ("source_domain", "reject_reason")),
        Table("staging.raw_json_records", {"staging_id": ident, "record_key": text, "source_domain": text, "source_file": text, "source_url": text, "payload": text, "ingested_at": stamp, "processed_at": stamp, "status": text}, "staging_id", (), (), ("source_domain", "source_file", "payload", "status")),
    ]
    return {x.name: x for x in t}


#: In an order in which parents come before children.
TABLES = _catalogue()
