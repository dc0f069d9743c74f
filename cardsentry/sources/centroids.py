"""Country centroids, the only geography the travel rule knows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardsentry.functions.geo import haversine_km

# Country code -> (latitude, longitude) in degrees.
CENTROIDS = {
    "US": (39.8, -98.6), "CA": (56.1, -106.3), "MX": (23.6, -102.6), "BR": (-14.2, -51.9),
    "AR": (-38.4, -63.6), "GB": (55.4, -3.4), "IE": (53.4, -8.2), "FR": (46.2, 2.2),
    "DE": (51.2, 10.5), "NL": (52.1, 5.3), "BE": (50.5, 4.5), "ES": (40.5, -3.7),
    "PT": (39.4, -8.2), "IT": (41.9, 12.6), "CH": (46.8, 8.2), "AT": (47.5, 14.6),
    "PL": (51.9, 19.1), "SE": (60.1, 18.6), "NO": (60.5, 8.5), "DK": (56.3, 9.5),
    "FI": (61.9, 25.7), "TR": (38.9, 35.2), "RU": (61.5, 105.3), "UA": (48.4, 31.2),
    "ZA": (-30.6, 22.9), "NG": (9.1, 8.7), "KE": (0.0, 37.9), "EG": (26.8, 30.8),
    "AE": (23.4, 53.8), "SA": (23.9, 45.1), "IN": (20.6, 79.0), "PK": (30.4, 69.3),
    "CN": (35.9, 104.2), "JP": (36.2, 138.3), "KR": (35.9, 127.8), "SG": (1.35, 103.8),
    "MY": (4.2, 101.98), "TH": (15.9, 101.0), "VN": (14.1, 108.3), "ID": (-0.8, 113.9),
    "PH": (12.9, 121.8), "AU": (-25.3, 133.8), "NZ": (-40.9, 174.9),
}


def centroids(spark: SparkSession) -> DataFrame:
    """(country, lat, lon); 43 rows, so broadcasting it is always safe."""
    rows = ", ".join(f"('{code}', {lat}D, {lon}D)" for code, (lat, lon) in CENTROIDS.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(country, lat, lon)")


def country_distances(spark: SparkSession) -> DataFrame:
    """(from_country, to_country, km) for every pair of known countries: 1849 rows.

    Looking a distance up is cheaper than working it out for each transaction, and keeps
    the trigonometry out of filters on the verdict.
    """
    target = F.expr("array(" + ", ".join(
        f"struct('{code}' AS to_country, {lat}D AS lat1, {lon}D AS lon1)"
        for code, (lat, lon) in CENTROIDS.items()) + ")")
    return (centroids(spark).select(F.col("country").alias("from_country"), "lat", "lon",
                                    F.explode(target).alias("t"))
            .select("from_country", "t.to_country", haversine_km(
                F.col("lat"), F.col("lon"), F.col("t.lat1"), F.col("t.lon1")).alias("km")))
