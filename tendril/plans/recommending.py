"""Label indexing, implicit ALS and its recommendations over the award pairs."""

from pyspark.sql import functions as F

from ..operators import recommend as rec
from ..operators.ordered import settle
from .merging import PAIRS, pairs
from .registry import query


@query("a76_label_index", f"""
    WITH {PAIRS} SELECT 'service' AS kind, service AS label, (row_number() OVER (ORDER BY count(*) DESC, service) - 1)::INT AS id FROM pairs GROUP BY 2
    UNION ALL SELECT 'contractor', contractor, (row_number() OVER (ORDER BY count(*) DESC, contractor) - 1)::INT FROM pairs GROUP BY 2""")
def label_index(t):
    found = settle(pairs(t), "pairs")
    index = lambda c: rec.label_index(found, c).select(F.lit(c).alias("kind"), F.col(c).alias("label"), F.col(f"{c}_id").alias("id"))
    return index("service").unionByName(index("contractor"))


@query("a77_constant_ratings", f"WITH {PAIRS} SELECT count(*) AS n, sum(1.0)::DOUBLE AS total FROM pairs")
def constant_ratings(t):
    found = settle(pairs(t), "pairs")
    rated = rec.indexed_pairs(found, rec.label_index(found, "service"), rec.label_index(found, "contractor"))
    return rated.agg(F.count("*").alias("n"), F.sum(F.col("rating").cast("double")).alias("total"))


_FITTED: dict[tuple[str, str], object] = {}


def _recommended(t):
    """The recommendations of these tables: fitted and scored once a session, read from the scratch folder after that."""
    key = (t.spark.sparkContext.applicationId, t.root)
    if key not in _FITTED:
        _FITTED[key] = settle(rec.recommendations(pairs(t)), "recommendations")
    return _FITTED[key]


@query("a78_service_recommendations")
def service_recommendations(t):
    """Ten services per contractor with their scores; scores depend on the partitioning, so tests check invariants."""
    return _recommended(t)


@query("a79_recommendation_counts", f"""
    WITH {PAIRS} SELECT contractor, least(10, (SELECT count(DISTINCT service) FROM pairs)) AS n FROM pairs GROUP BY 1""")
def recommendation_counts(t):
    return _recommended(t).groupBy("contractor").agg(F.count("*").alias("n"))


@query("a80_labels_of_recommendations", f"""
    WITH {PAIRS} SELECT contractor, least(10, (SELECT count(DISTINCT service) FROM pairs)) AS n_services, 0::BIGINT AS n_unknown FROM pairs GROUP BY 1""")
def labels_of_recommendations(t):
    """Every name that comes back for an index stands in the pairs, each service once a contractor."""
    known = pairs(t).select(F.col("service").alias("known")).distinct()
    held = _recommended(t).join(known, F.col("service") == F.col("known"), "left")
    return held.groupBy("contractor").agg(F.count_distinct("service").alias("n_services"), F.count_if(F.col("known").isNull()).alias("n_unknown"))


@query("a81_incidence", f"WITH {PAIRS} SELECT DISTINCT service, contractor, 1 AS present FROM pairs")
def incidence(t):
    return rec.incidence(pairs(t))


@query("a82_recommend_for_one")
def recommend_for_one(t):
    """Scores for the most frequent contractor only."""
    found = settle(pairs(t), "pairs")
    services, contractors = (settle(rec.label_index(found, c), c) for c in ("service", "contractor"))
    model = rec.fit(rec.indexed_pairs(rec.incidence(found).select("service", "contractor"), services, contractors), rank=50)
    return rec.top_services(model, services, contractors, 10, contractors.filter("contractor_id = 0").select("contractor_id"))
