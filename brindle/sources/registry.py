"""Static dimensions that ship with the library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions import urls

#: Known sources. Host (its subdomains too; the first that fits counts), class, owner, group of owners.
SOURCES = [
    ("haypp.com", "retailer", "Haypp Group", "haypp-group"),
    ("northerner.com", "retailer", "Haypp Group", "haypp-group"),
    ("nicopodsuk.com", "retailer", "NicoPODS UK", "nicopodsuk"),
    ("snusdirect.com", "retailer", "Snusdirect", "snusdirect"),
    ("velo.com", "official", "BAT / VELO", "bat-velo"),
    ("zyn.com", "official", "Swedish Match / ZYN", "swedish-match-zyn"),
    ("nordicspirit.co.uk", "official", "JTI / Nordic Spirit", "jti-nordic-spirit"),
    ("fumipods.com", "official", "Helix Sweden / Fumi", "helix-fumi"),
    ("pablopouch.com", "official", "Pablo", "pablo"),
    ("fda.gov", "regulator", "US FDA", "us-fda"),
    ("accessdata.fda.gov", "regulator", "US FDA", "us-fda"),
    ("canada.ca", "regulator", "Health Canada", "health-canada"),
    ("folkhalsomyndigheten.se", "regulator", "Swedish Public Health Agency", "swedish-ph"),
    ("sik.dk", "regulator", "Danish Safety Technology Authority", "danish-safety"),
]


def known_sources(spark: SparkSession) -> DataFrame:
    """ord, host, source_class, owner, owner_group_id."""
    return spark.createDataFrame([(i, *row) for i, row in enumerate(SOURCES)], "ord int, host string, source_class string, owner string, owner_group_id string")


def with_source(df: DataFrame, url: str, registry: DataFrame | None = None) -> DataFrame:
    """Adds source_class (``unknown`` where no source fits or the address has no host), owner and owner_group_id of each address."""
    got = urls.owner_join(df, url, registry if registry is not None else known_sources(df.sparkSession))
    return got.withColumn("source_class", F.coalesce("source_class", F.lit("unknown")))
