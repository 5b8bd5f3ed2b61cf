"""Sensor presets: collection name, band aliases and default item query."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions import values as V


@dataclass(frozen=True)
class Sensor:
    name: str
    common_name: str
    bands: dict[str, str]  # common alias -> provider band
    query: dict = field(default_factory=dict)


_RADAR = {"hh": "hh", "hv": "hv", "vh": "vh", "vv": "vv"}
_S2 = {
    "blue": "B02", "green": "B03", "red": "B04", "rededge1": "B05", "rededge2": "B06",
    "rededge3": "B07", "nir": "B08", "swir16": "B11", "swir22": "B12",
}
_NBART = {
    "blue": "nbart_blue", "green": "nbart_green", "red": "nbart_red", "nir": "nbart_nir",
    "swir16": "nbart_swir_1", "swir22": "nbart_swir_2", "fmask": "oa_fmask",
}

# Public collection names and their band names.
PRESETS = {
    s.name: s
    for s in (
        Sensor("ga_ls8c_ard_3", "Landsat-8", _NBART),
        Sensor("ga_ls9c_ard_3", "Landsat-9", _NBART),
        Sensor(
            "ga_s2bm_ard_3",
            "Sentinel-2B",
            {**_NBART, "nir": "nbart_nir_1", "swir16": "nbart_swir_2", "swir22": "nbart_swir_3"},
        ),
        Sensor(
            "landsat-c2-l2",
            "Landsat-8",
            {
                "blue": "blue", "green": "green", "red": "red", "nir": "nir08", "emis": "emis", "lwir11": "lwir11",
                "swir16": "swir16", "swir22": "swir22", "mask": "qa_pixel",
            },
            {"eo:cloud_cover": {"lt": 20}, "platform": {"in": ["landsat-8"]}},
        ),
        Sensor("sentinel-2-l2a", "Sentinel-2A", {**_S2, "mask": "SCL"}, {"eo:cloud_cover": {"lt": 20}}),
        Sensor("hls2-s30", "Harmonised Landsat/Sentinel-2", {**_S2, "mask": "Fmask"}),
        Sensor("sentinel-1-rtc", "Sentinel 1 Radiometrically Terrain Corrected", _RADAR),
        Sensor("sentinel-1-grd", "Sentinel 1 Level-1 Ground Range Detected", _RADAR),
    )
}


def sensors_table(spark: SparkSession) -> DataFrame:
    """name, common_name, bands MAP: the presets as a table."""
    return spark.createDataFrame(
        [(s.name, s.common_name, s.bands) for s in PRESETS.values()],
        "name string, common_name string, bands map<string,string>",
    )


def apply_band_aliases(pixels: DataFrame, sensor: str | Sensor) -> DataFrame:
    """Provider band columns renamed to the common aliases of a preset."""
    s = PRESETS[sensor] if isinstance(sensor, str) else sensor
    return pixels.withColumnsRenamed({band: alias for alias, band in s.bands.items() if band in pixels.columns})


def safe_columns(df: DataFrame) -> DataFrame:
    """All column names made safe (``: . /`` and space become underscores)."""
    return df.toDF(*[V.safe_name(c) for c in df.columns])
