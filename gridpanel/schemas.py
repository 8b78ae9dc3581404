"""Fixed table schemas of the pipeline's outputs."""

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

ANNUAL_TEMP = StructType([
    StructField("country", StringType()),
    StructField("year", IntegerType()),
    StructField("temp_c", DoubleType()),
])

# Raw CO2 column -> output column (fixed values).
CO2_RENAME = {
    "iso_code": "iso3",
    "country": "country",
    "year": "year",
    "co2": "co2_mt",
    "co2_per_capita": "co2_t_per_capita",
    "share_global_co2": "share_global_co2_pct",
    "consumption_co2": "consumption_co2_mt",
}
CO2_COLUMNS = list(CO2_RENAME.values())

CO2 = StructType([
    StructField("iso3", StringType()),
    StructField("country", StringType()),
    StructField("year", IntegerType()),
    StructField("co2_mt", DoubleType()),
    StructField("co2_t_per_capita", DoubleType()),
    StructField("share_global_co2_pct", DoubleType()),
    StructField("consumption_co2_mt", DoubleType()),
])

# Indicator code -> short column name (fixed values).
INDICATORS = {
    "NY.GDP.PCAP.KD": "gdp_pc_const_usd",
    "GE.EST": "wgi_gov_effectiveness",
    "RL.EST": "wgi_rule_of_law",
    "RQ.EST": "wgi_reg_quality",
    "CC.EST": "wgi_control_corruption",
    "PV.EST": "wgi_political_stability",
    "VA.EST": "wgi_voice_accountability",
}

ERA5_KEEP = ["iso3", "year", "country", "temp_c"]
OWID_KEEP = ["iso3", "year", *(f.name for f in CO2.fields if isinstance(f.dataType, DoubleType))]
WB_KEEP = ["iso3", "year"] + list(INDICATORS.values())
ENRICHED_COLUMNS = ERA5_KEEP + OWID_KEEP[2:] + WB_KEEP[2:]
