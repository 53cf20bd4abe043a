"""Scoring, validation, route resolution and drift queries (DQ-14, JON-13..15,
SCO-3, SCO-6..10, SCO-12, UDF-4)."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import haversine_km, r
from ..operators.ranking import attach, exact_quantiles
from ..registry import ORACLE, query
from ..session import checkpoint_dir, stored
from ..sources.fixtures import market
from .core import memo
from .q_audit import audited
from .q_eval import item_split, split
from .q_features import tariff

LN15 = math.log(1.5)


# ---------------------------------------------------------------- DQ-14 row validation
def freight_records(m):
    """Scoring records for the freight service: the hold-out lines as a client would send them."""
    _, test = item_split(m)
    return test.select(F.concat_ws("-", F.col("order_id").cast("string"), F.col("order_item_id").cast("string"))
                       .alias("id"), "order_id", "order_item_id", "category", "price", "weight_kg", "volume_cm3",
                       "n_items", "n_sellers", "seller_state", "customer_state", "distance_km", "freight_value",
                       "chargeable_kg", "same_state")


def validate(records, states):
    """DQ-14: typed ranges, allowed state codes (left join to the state table), cross-field rule; all errors
    of a row in one array; returns (valid, rejected)."""
    ok_s = states.select(F.col("state").alias("seller_state"), F.lit(True).alias("_s_ok"))
    ok_c = states.select(F.col("state").alias("customer_state"), F.lit(True).alias("_c_ok"))
    x = records.join(F.broadcast(ok_s), "seller_state", "left").join(F.broadcast(ok_c), "customer_state", "left")
    c = F.col
    errors = F.array_compact(F.array(
        F.when(c("price").isNull() | (c("price") <= 0) | (c("price") > 100000), F.lit("price must be in (0, 100000]")),
        F.when(c("weight_kg").isNull(), F.lit("weight_kg is required"))
        .when((c("weight_kg") < 0) | (c("weight_kg") > 500), F.lit("weight_kg must be in [0, 500]")),
        F.when(c("volume_cm3").isNull() | (c("volume_cm3") <= 0) | (c("volume_cm3") > 5e6),
               F.lit("volume_cm3 must be in (0, 5000000]")),
        F.when((c("n_items") < 1) | (c("n_items") > 100), F.lit("n_items must be in [1, 100]")),
        F.when((c("n_sellers") < 1) | (c("n_sellers") > 20), F.lit("n_sellers must be in [1, 20]")),
        F.when(c("_s_ok").isNull(), F.lit("seller_state is not a known state code")),
        F.when(c("_c_ok").isNull(), F.lit("customer_state is not a known state code")),
        F.when(c("distance_km").isNotNull() & ((c("distance_km") < 0) | (c("distance_km") > 5000)),
               F.lit("distance_km must be in [0, 5000]")),
        F.when(c("freight_value").isNotNull() & ((c("freight_value") < 0) | (c("freight_value") > 10000)),
               F.lit("freight_value must be in [0, 10000]")),
        F.when(c("n_sellers") > c("n_items"), F.lit("n_sellers cannot exceed n_items"))))
    y = x.withColumn("errors", errors).drop("_s_ok", "_c_ok")
    return y.filter(F.size("errors") == 0), y.filter(F.size("errors") > 0)


def _states(m):
    return m.raw("nation").select(F.col("n_name").alias("state"))


_RECORDS_SQL = """
rec AS (SELECT CAST(order_id AS VARCHAR) || '-' || CAST(order_item_id AS VARCHAR) AS id, * FROM f_itest),
v AS (SELECT rec.*, list_filter([
        CASE WHEN price IS NULL OR price <= 0 OR price > 100000 THEN 'price must be in (0, 100000]' END,
        CASE WHEN weight_kg IS NULL THEN 'weight_kg is required'
             WHEN weight_kg < 0 OR weight_kg > 500 THEN 'weight_kg must be in [0, 500]' END,
        CASE WHEN volume_cm3 IS NULL OR volume_cm3 <= 0 OR volume_cm3 > 5e6 THEN 'volume_cm3 must be in (0, 5000000]' END,
        CASE WHEN n_items < 1 OR n_items > 100 THEN 'n_items must be in [1, 100]' END,
        CASE WHEN n_sellers < 1 OR n_sellers > 20 THEN 'n_sellers must be in [1, 20]' END,
        CASE WHEN seller_state NOT IN (SELECT n_name FROM nation) OR seller_state IS NULL
             THEN 'seller_state is not a known state code' END,
        CASE WHEN customer_state NOT IN (SELECT n_name FROM nation) OR customer_state IS NULL
             THEN 'customer_state is not a known state code' END,
        CASE WHEN distance_km IS NOT NULL AND (distance_km < 0 OR distance_km > 5000) THEN 'distance_km must be in [0, 5000]' END,
        CASE WHEN freight_value IS NOT NULL AND (freight_value < 0 OR freight_value > 10000)
             THEN 'freight_value must be in [0, 10000]' END,
        CASE WHEN n_sellers > n_items THEN 'n_sellers cannot exceed n_items' END], lambda e: e IS NOT NULL) AS errors
      FROM rec)"""


@query("dq14_row_validation", f"""
WITH {_RECORDS_SQL}
SELECT 'all' AS what, count(*) AS n FROM v
UNION ALL SELECT 'valid', count(*) FROM v WHERE len(errors) = 0
UNION ALL SELECT 'rejected', count(*) FROM v WHERE len(errors) > 0
UNION ALL SELECT e, count(*) FROM (SELECT unnest(errors) AS e FROM v) GROUP BY e
""")
def dq14_row_validation(spark, sf):
    """DQ-14: validation of the hold-out lines as scoring records: valid / rejected counts and rows per error
    message (all errors of a row are kept)."""
    m = market(spark, sf)
    valid, rejected = validate(freight_records(m), _states(m))
    a = valid.agg(F.lit("valid").alias("what"), F.count(F.lit(1)).alias("n"))
    b = rejected.agg(F.lit("rejected").alias("what"), F.count(F.lit(1)).alias("n"))
    allr = valid.unionByName(rejected).agg(F.lit("all").alias("what"), F.count(F.lit(1)).alias("n"))
    e = (rejected.select(F.explode("errors").alias("what")).groupBy("what").agg(F.count(F.lit(1)).alias("n")))
    return allr.unionByName(a).unionByName(b).unionByName(e)


# ---------------------------------------------------------------- JON-13 nearest zip, JON-14 route
def zip_table(m):
    """Known zips with centroid and majority state (AGG-1 + AGG-2); at most 100k rows (5-digit prefixes)."""
    def build():
        g = m.geolocation
        zs = g.groupBy(F.col("geolocation_zip_code_prefix").alias("zip"), F.col("geolocation_state").alias("state")).agg(
            F.count(F.lit(1)).alias("n"))
        zm = zs.groupBy("zip").agg(F.max_by("state", F.struct("n", "state")).alias("state"))
        return zm.join(m.zip_centroids.select("zip", "lat", "lng"), "zip")
    return memo(m, "zip_table", build)


def state_centres(m):
    z = zip_table(m)
    return z.groupBy("state").agg(F.median("lat").alias("c_lat"), F.median("lng").alias("c_lng"))


def nearest_zips(zips):
    """For every five-digit prefix (100,000 at most) the known zip of its 3-digit region that is numerically
    nearest, ties to the lower one: a bounded table, built once and joined on the zip itself."""
    z = zips.select(F.col("zip").alias("_z"), F.floor(F.col("zip") / 100).alias("_region"),
                    F.col("lat").alias("_lat"), F.col("lng").alias("_lng"), F.col("state").alias("_zstate"))
    every = zips.sparkSession.range(100_000).select(F.col("id").alias("_prefix"), F.floor(F.col("id") / 100).alias("_region"))
    return every.join(F.broadcast(z), "_region").groupBy("_prefix").agg(
        F.min_by(F.struct("_z", "_lat", "_lng", "_zstate"), F.struct(F.abs(F.col("_z") - F.col("_prefix")), F.col("_z"))).alias("b"))


def locate(probes, zips, centres, who: str):
    """JON-13: probe (pid, zip, state) -> (lat, lng, state, from_zip, notes): the same zip if known, else the
    numerically nearest zip in the same 3-digit region (ties to the lower zip), else the state centre; a zip
    in another state overrides the state.  A probe is one row throughout."""
    j = (probes.join(F.broadcast(nearest_zips(zips)), F.col("zip") == F.col("_prefix"), "left")
         .join(F.broadcast(centres.select(F.col("state").alias("_cs"), "c_lat", "c_lng")),
               F.col("state") == F.col("_cs"), "left"))
    found = F.col("b").isNotNull()
    zs = F.format_string("%05d", F.col("zip").cast("int"))
    near = F.format_string("%05d", F.col("b._z").cast("int"))
    notes = F.array_compact(F.array(
        F.when(F.col("zip").isNotNull() & ~found,
               F.concat(F.lit(f"{who} zip "), zs, F.lit(" is unknown and stands at the centre of "),
                        F.col("state"), F.lit("."))),
        F.when(found & (F.col("b._z") != F.col("zip")),
               F.concat(F.lit(f"{who} zip "), zs, F.lit(" is unknown; its closest known neighbour is "), near,
                        F.lit("."))),
        F.when(found & (F.col("b._zstate") != F.col("state")),
               F.concat(F.lit(f"{who} zip "), near, F.lit(" is in "), F.col("b._zstate"), F.lit(", not "),
                        F.col("state"), F.lit("; the state is taken as "), F.col("b._zstate"), F.lit(".")))))
    return j.select("pid",
                    F.when(found, F.col("b._lat")).otherwise(F.col("c_lat")).alias("lat"),
                    F.when(found, F.col("b._lng")).otherwise(F.col("c_lng")).alias("lng"),
                    F.when(found, F.col("b._zstate")).otherwise(F.col("state")).alias("state"),
                    found.alias("from_zip"), F.when(found, F.col("b._z")).alias("nearest"), notes.alias("notes"))


_ZIPS_SQL = """
zs AS (SELECT geolocation_zip_code_prefix AS zip, geolocation_state AS state, count(*) AS n FROM f_geo GROUP BY 1, 2),
zt AS (SELECT z.zip, arg_max(z.state, (z.n, z.state)) AS state, max(c.lat) AS lat, max(c.lng) AS lng
       FROM zs z JOIN f_centroids c ON z.zip = c.zip GROUP BY z.zip),
sc AS (SELECT state, median(lat) AS c_lat, median(lng) AS c_lng FROM zt GROUP BY 1)"""


def _locate_sql(probe_view, who):
    return f"""
SELECT p.pid, CASE WHEN b.z IS NOT NULL THEN b.lat ELSE sc.c_lat END AS lat,
       CASE WHEN b.z IS NOT NULL THEN b.lng ELSE sc.c_lng END AS lng,
       CASE WHEN b.z IS NOT NULL THEN b.zstate ELSE p.state END AS state, b.z IS NOT NULL AS from_zip, b.z AS nearest,
       list_filter([CASE WHEN p.zip IS NOT NULL AND b.z IS NULL THEN '{who} zip ' || lpad(CAST(p.zip AS VARCHAR), 5, '0')
                         || ' is unknown and stands at the centre of ' || p.state || '.' END,
                    CASE WHEN b.z IS NOT NULL AND b.z <> p.zip THEN '{who} zip ' || lpad(CAST(p.zip AS VARCHAR), 5, '0')
                         || ' is unknown; its closest known neighbour is ' || lpad(CAST(b.z AS VARCHAR), 5, '0') || '.' END,
                    CASE WHEN b.z IS NOT NULL AND b.zstate <> p.state THEN '{who} zip ' || lpad(CAST(b.z AS VARCHAR), 5, '0')
                         || ' is in ' || b.zstate || ', not ' || p.state || '; the state is taken as ' || b.zstate || '.' END],
                   lambda x: x IS NOT NULL) AS notes
FROM {probe_view} p
LEFT JOIN (SELECT p2.pid, arg_min(zt.zip, (abs(zt.zip - p2.zip), zt.zip)) AS z,
                  arg_min(zt.lat, (abs(zt.zip - p2.zip), zt.zip)) AS lat, arg_min(zt.lng, (abs(zt.zip - p2.zip), zt.zip)) AS lng,
                  arg_min(zt.state, (abs(zt.zip - p2.zip), zt.zip)) AS zstate
           FROM {probe_view} p2 JOIN zt ON floor(zt.zip / 100) = floor(p2.zip / 100) WHERE p2.zip IS NOT NULL
           GROUP BY p2.pid) b ON p.pid = b.pid
LEFT JOIN sc ON p.state = sc.state"""


def _customer_probes(m):
    """Probe zips from the test orders: the customer's zip shifted by 0..6 (some unknown, some in another
    state, some outside every known region)."""
    _, test = split(m)
    c = m.customers.select(F.col("customer_id").alias("order_id"), "customer_zip_code_prefix")
    t = test.select("order_id", "customer_state").join(c, "order_id")
    return t.select(F.col("order_id").alias("pid"),
                    (F.col("customer_zip_code_prefix") + F.col("order_id") % 7).alias("zip"),
                    F.col("customer_state").alias("state"))


_PROBES_SQL = """
probes AS (SELECT t.order_id AS pid, c.customer_zip_code_prefix + t.order_id % 7 AS zip, t.customer_state AS state
           FROM f_test t JOIN f_customers c ON t.order_id = c.customer_id)"""


@query("jon13_nearest_zip", f"""
WITH {_ZIPS_SQL}, {_PROBES_SQL}, loc AS ({_locate_sql('probes', 'Customer')})
SELECT pid, round_even(lat, 6) AS lat, round_even(lng, 6) AS lng, state, from_zip, nearest,
       array_to_string(notes, ' | ') AS notes FROM loc
""")
def jon13_nearest_zip(spark, sf):
    """JON-13: customer location of each test order from a (possibly unknown) zip: same zip, nearest zip in
    the 3-digit region (ties to the lower), else the state centre; notes explain each fallback."""
    m = market(spark, sf)
    loc = locate(_customer_probes(m), zip_table(m), state_centres(m), "Customer")
    return loc.select("pid", r("lat", 6).alias("lat"), r("lng", 6).alias("lng"), "state", "from_zip", "nearest",
                      F.concat_ws(" | ", "notes").alias("notes"))


def resolve_route(records, zips, centres):
    """JON-14: seller and customer placed by JON-13; a given distance wins, an explicit null stays null,
    otherwise the distance is measured between the resolved points; the zip's state overrides; notes."""
    s = locate(records.select(F.col("id").alias("pid"), F.col("seller_zip").alias("zip"),
                              F.col("seller_state").alias("state")), zips, centres, "Seller")
    c = locate(records.select(F.col("id").alias("pid"), F.col("customer_zip").alias("zip"),
                              F.col("customer_state").alias("state")), zips, centres, "Customer")
    s = s.select(F.col("pid").alias("id"), *[F.col(x).alias(f"s_{x}") for x in ("lat", "lng", "state", "from_zip",
                                                                                 "notes")])
    c = c.select(F.col("pid").alias("id"), *[F.col(x).alias(f"c_{x}") for x in ("lat", "lng", "state", "from_zip",
                                                                                 "notes")])
    j = records.join(s, "id").join(c, "id")
    measured = haversine_km("s_lat", "s_lng", "c_lat", "c_lng")
    dist = (F.when(F.col("distance_given") & F.col("distance_in").isNotNull(), F.col("distance_in"))
            .when(F.col("distance_given"), F.lit(None).cast("double")).otherwise(measured))

    def where(frm, st):
        return F.when(F.col(frm), F.lit("zip code")).otherwise(F.concat(F.lit("centre of "), F.col(st)))
    dnote = (F.when(F.col("distance_given") & F.col("distance_in").isNull(),
                    F.lit("No distance is known, so the median of the training lines stands in."))
             .when(~F.col("distance_given") & ~(F.col("s_from_zip") & F.col("c_from_zip")),
                   F.concat(F.lit("The distance runs from the seller's "), where("s_from_zip", "s_state"),
                            F.lit(" to the customer's "), where("c_from_zip", "c_state"), F.lit("."))))
    return j.select("id", F.col("s_state").alias("seller_state"), F.col("c_state").alias("customer_state"),
                    dist.alias("distance_km"), (F.col("s_state") == F.col("c_state")).cast("int").alias("same_state"),
                    F.concat(F.col("s_notes"), F.col("c_notes"), F.array_compact(F.array(dnote))).alias("notes"))


def route_records(m):
    """Route requests from the test orders: seller and customer zips shifted by a few units, a distance
    given for every third order, explicitly unknown for every 50th."""
    _, test = split(m)
    c = m.customers.select(F.col("customer_id").alias("order_id"), "customer_zip_code_prefix")
    sz = m.sellers.select("seller_id", "seller_zip_code_prefix")
    t = test.select("order_id", "seller_id", "seller_state", "customer_state", "distance_km").join(c, "order_id") \
        .join(sz, "seller_id")
    k = F.col("order_id")
    return t.select(k.cast("string").alias("id"), "seller_state", "customer_state",
                    (F.col("seller_zip_code_prefix") + k % 5).alias("seller_zip"),
                    (F.col("customer_zip_code_prefix") + k % 7).alias("customer_zip"),
                    ((k % 3 == 0) | (k % 50 == 0)).alias("distance_given"),
                    F.when(k % 50 == 0, F.lit(None).cast("double")).otherwise(F.col("distance_km")).alias("distance_in"))


_ROUTE_SQL = """
rr AS (SELECT CAST(t.order_id AS VARCHAR) AS id, t.seller_state, t.customer_state,
              s.seller_zip_code_prefix + t.order_id % 5 AS seller_zip,
              c.customer_zip_code_prefix + t.order_id % 7 AS customer_zip,
              (t.order_id % 3 = 0 OR t.order_id % 50 = 0) AS distance_given,
              CASE WHEN t.order_id % 50 = 0 THEN NULL ELSE t.distance_km END AS distance_in
       FROM f_test t JOIN f_customers c ON t.order_id = c.customer_id JOIN f_sellers s ON t.seller_id = s.seller_id),
sp AS (SELECT id AS pid, seller_zip AS zip, seller_state AS state FROM rr),
cp AS (SELECT id AS pid, customer_zip AS zip, customer_state AS state FROM rr)"""


@query("jon14_route_resolution", f"""
WITH {_ZIPS_SQL}, {_ROUTE_SQL}, sl AS ({_locate_sql('sp', 'Seller')}), cl AS ({_locate_sql('cp', 'Customer')}),
j AS (SELECT rr.*, sl.lat AS s_lat, sl.lng AS s_lng, sl.state AS s_state, sl.from_zip AS s_from, sl.notes AS s_notes,
             cl.lat AS c_lat, cl.lng AS c_lng, cl.state AS c_state, cl.from_zip AS c_from, cl.notes AS c_notes
      FROM rr JOIN sl ON rr.id = sl.pid JOIN cl ON rr.id = cl.pid),
d AS (SELECT *, CASE WHEN distance_given AND distance_in IS NOT NULL THEN distance_in WHEN distance_given THEN NULL
                     ELSE 2 * 6371.0 * asin(sqrt(pow(sin((radians(c_lat) - radians(s_lat)) / 2), 2)
                          + cos(radians(s_lat)) * cos(radians(c_lat)) * pow(sin((radians(c_lng) - radians(s_lng)) / 2), 2)))
                END AS dist,
             CASE WHEN distance_given AND distance_in IS NULL THEN 'No distance is known, so the median of the training lines stands in.'
                  WHEN NOT distance_given AND NOT (s_from AND c_from) THEN 'The distance runs from the seller''s '
                       || CASE WHEN s_from THEN 'zip code' ELSE 'centre of ' || s_state END || ' to the customer''s '
                       || CASE WHEN c_from THEN 'zip code' ELSE 'centre of ' || c_state END || '.' END AS dnote FROM j)
SELECT id, s_state AS seller_state, c_state AS customer_state, round_even(dist, 6) AS distance_km,
       (s_state = c_state)::INT AS same_state,
       array_to_string(list_concat(list_concat(s_notes, c_notes), list_filter([dnote], lambda x: x IS NOT NULL)), ' | ')
           AS notes
FROM d
""")
def jon14_route_resolution(spark, sf):
    """JON-14: route resolution for route requests derived from the test orders."""
    m = market(spark, sf)
    rt = resolve_route(route_records(m), zip_table(m), state_centres(m))
    return rt.select("id", "seller_state", "customer_state", r("distance_km", 6).alias("distance_km"), "same_state",
                     F.concat_ws(" | ", "notes").alias("notes"))


# ---------------------------------------------------------------- JON-15 similar items
def similar_items(queries, candidates, n: int = 5):
    """JON-15: up to n candidates like each query line: same category and customer state, chargeable weight
    within x1.5, distance within max(25%, 150 km); same route first, then the smallest gaps.

    A banded equi-join: candidates are keyed by (category, state, weight band of width ln 1.5, distance band
    of 150 km); each query explodes only the bands its tolerance can reach, so only pairs that can satisfy
    the theta conditions are formed -- never all pairs of a category.  Each task keeps the best ``n`` of its pairs of a
    query before the shuffle (the rank limit is applied on both sides of it), so a query's window holds at most ``n`` rows
    a task.  A hot cell still has all its pairs compared once."""
    kgb = F.floor(F.log(F.col("chargeable_kg") + 0.1) / LN15)
    c = candidates.filter(F.col("distance_km").isNotNull() & F.col("chargeable_kg").isNotNull()).select(
        F.col("key").alias("c_key"), "category", "customer_state", F.col("seller_state").alias("c_seller_state"),
        F.col("chargeable_kg").alias("c_ckg"), F.col("distance_km").alias("c_km"),
        kgb.alias("kgb"), F.floor(F.col("distance_km") / 150).alias("kmb"))
    w = F.greatest(F.col("distance_km") * 0.25, F.lit(150.0))
    q = (queries.filter(F.col("distance_km").isNotNull() & F.col("chargeable_kg").isNotNull())
         .select(F.col("key").alias("q_key"), "category", "customer_state", "seller_state",
                 F.col("chargeable_kg").alias("q_ckg"), F.col("distance_km").alias("q_km"),
                 F.explode(F.sequence(kgb - 1, kgb + 1)).alias("kgb"),
                 F.floor((F.col("distance_km") - w) / 150).alias("_lo"),
                 F.floor((F.col("distance_km") + w) / 150).alias("_hi"))
         .select("*", F.explode(F.sequence("_lo", "_hi")).alias("kmb")).drop("_lo", "_hi"))
    j = q.join(c, ["category", "customer_state", "kgb", "kmb"]).filter(F.col("q_key") != F.col("c_key"))
    kg_gap = F.abs(F.log((F.col("c_ckg") + 0.1) / (F.col("q_ckg") + 0.1))) / LN15
    km_gap = F.abs(F.col("c_km") - F.col("q_km")) / F.greatest(F.col("q_km") * 0.25, F.lit(150.0))
    j = j.select("q_key", "c_key", kg_gap.alias("kg_gap"), km_gap.alias("km_gap"),
                 (F.col("c_seller_state") != F.col("seller_state")).cast("double").alias("other_route"))
    j = j.filter((F.col("kg_gap") <= 1) & (F.col("km_gap") <= 1))
    j = j.withColumn("gap", F.col("other_route") * 10 + F.col("kg_gap") + F.col("km_gap"))
    w_rank = Window.partitionBy("q_key").orderBy("gap", "c_key")
    return j.withColumn("rank", F.row_number().over(w_rank)).filter(F.col("rank") <= n)


@query("jon15_similar_items", """
WITH q AS (SELECT order_id || '-' || order_item_id AS key, * FROM f_audit WHERE p_a = 1),
c AS (SELECT order_id || '-' || order_item_id AS key, * FROM f_itest),
j AS (SELECT q.key AS q_key, c.key AS c_key,
             abs(ln((c.chargeable_kg + 0.1) / (q.chargeable_kg + 0.1))) / ln(1.5) AS kg_gap,
             abs(c.distance_km - q.distance_km) / greatest(q.distance_km * 0.25, 150.0) AS km_gap,
             (c.seller_state <> q.seller_state)::DOUBLE AS other_route
      FROM q JOIN c ON q.category = c.category AND q.customer_state = c.customer_state
      WHERE q.key <> c.key AND c.distance_km IS NOT NULL AND c.chargeable_kg IS NOT NULL
        AND q.chargeable_kg IS NOT NULL),
k AS (SELECT *, other_route * 10 + kg_gap + km_gap AS gap FROM j WHERE kg_gap <= 1 AND km_gap <= 1),
rk AS (SELECT *, row_number() OVER (PARTITION BY q_key ORDER BY gap, c_key) AS rank FROM k)
SELECT q_key, c_key, rank, round_even(gap, 6) AS gap FROM rk WHERE rank <= 5
""")
def jon15_similar_items(spark, sf):
    """JON-15: for every line flagged by the audit, the 5 most similar hold-out lines."""
    m = market(spark, sf)
    _, test = item_split(m)
    key = F.concat_ws("-", F.col("order_id").cast("string"), F.col("order_item_id").cast("string")).alias("key")
    qs = audited(m).filter(F.col("p_a") == 1).select(key, "category", "customer_state", "seller_state",
                                                      "chargeable_kg", "distance_km")
    cs = test.select(key, "category", "customer_state", "seller_state", "chargeable_kg", "distance_km")
    s = similar_items(qs, cs, 5)
    return s.select("q_key", "c_key", "rank", r("gap", 6).alias("gap"))


# ---------------------------------------------------------------- SCO-6..8, SCO-12 drift statistics and flags
NUMERIC_LOG = ["price", "weight_kg", "volume_cm3", "chargeable_kg", "distance_km"]
COUNTS = ["n_items", "n_sellers"]
CATEGORICAL = ["category", "seller_state", "customer_state"]


def drift_stats(train):
    """SCO-6: numeric inputs on the log1p scale (mean, population-free sample sd, 3-sd band, share of training
    rows outside it), counts (max), categorical level counts.  One aggregation pass each."""
    aggs = []
    for c in NUMERIC_LOG:
        v = F.when(F.col(c).isNotNull(), F.log1p(F.greatest(F.col(c), F.lit(0.0))))
        aggs += [F.avg(v).alias(f"{c}__mean"), F.stddev_samp(v).alias(f"{c}__std"), F.count(v).alias(f"{c}__n")]
    for c in COUNTS:
        aggs += [F.count(c).alias(f"{c}__n"), F.max(c).cast("double").alias(f"{c}__max")]
    none = F.lit(None).cast("double")
    rows = [F.struct(F.lit(c).alias("column"), F.lit("log1p").alias("scale"), F.col(f"{c}__mean").alias("mean"),
                     F.col(f"{c}__std").alias("std"), F.col(f"{c}__n").alias("n"),
                     (F.col(f"{c}__mean") - 3 * F.col(f"{c}__std")).alias("low"),
                     (F.col(f"{c}__mean") + 3 * F.col(f"{c}__std")).alias("high"), none.alias("max")) for c in NUMERIC_LOG]
    rows += [F.struct(F.lit(c).alias("column"), F.lit("count").alias("scale"), none.alias("mean"), none.alias("std"),
                      F.col(f"{c}__n").alias("n"), none.alias("low"), none.alias("high"), F.col(f"{c}__max").alias("max"))
             for c in COUNTS]
    return train.agg(*aggs).select(F.explode(F.array(*rows)).alias("e")).select("e.*")


def level_counts(train):
    """SCO-6: training rows per level of each categorical input (long form)."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in CATEGORICAL]))
    return train.select(each.alias("e")).groupBy("e.column", "e.level").agg(F.count(F.lit(1)).alias("n"))


def _drift_sql_numeric():
    parts = []
    for c in NUMERIC_LOG:
        v = f"CASE WHEN {c} IS NOT NULL THEN ln(1 + greatest({c}, 0.0)) END"
        parts.append(f"SELECT '{c}' AS \"column\", 'log1p' AS scale, avg({v}) AS mean, stddev_samp({v}) AS std, "
                     f"count({v}) AS n, avg({v}) - 3 * stddev_samp({v}) AS low, avg({v}) + 3 * stddev_samp({v}) AS high, "
                     f"NULL::DOUBLE AS max FROM f_itrain")
    for c in COUNTS:
        parts.append(f"SELECT '{c}', 'count', NULL::DOUBLE, NULL::DOUBLE, count({c}), NULL::DOUBLE, NULL::DOUBLE, "
                     f"max({c})::DOUBLE FROM f_itrain")
    return "\nUNION ALL ".join(parts)


@query("sco06_drift_stats", f"""
SELECT "column", scale, round_even(mean, 6) AS mean, round_even(std, 6) AS std, n, round_even(low, 6) AS low,
       round_even(high, 6) AS high, max FROM ({_drift_sql_numeric()})
""")
def sco06_drift_stats(spark, sf):
    """SCO-6: drift statistics of the fair-freight inputs, fitted on the training window."""
    train, _ = item_split(market(spark, sf))
    s = drift_stats(train)
    return s.select("column", "scale", r("mean", 6).alias("mean"), r("std", 6).alias("std"), "n",
                    r("low", 6).alias("low"), r("high", 6).alias("high"), "max")


@query("sco06_level_counts", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS level, count(*) AS n FROM f_itrain GROUP BY 2"
    for c in CATEGORICAL))
def sco06_level_counts(spark, sf):
    """SCO-6: categorical level counts of the training window."""
    train, _ = item_split(market(spark, sf))
    return level_counts(train)


def drift_flags(rows, stats, levels, min_frequency: int = 20):
    """SCO-7 / SCO-8: per row the inputs beyond 3 sd (log scale), counts above the training max, unseen levels
    (all from broadcast statistics tables of bounded size), and rare-level notes (0 < n < min_frequency)."""
    wide = stats.groupBy().pivot("column", NUMERIC_LOG + COUNTS).agg(
        F.first(F.struct("mean", "std", "max")))
    x = attach(rows, wide.select(*[F.col(c).alias(f"_st_{c}") for c in NUMERIC_LOG + COUNTS]))
    flags = []
    for c in NUMERIC_LOG:
        v = F.when(F.col(c).isNotNull(), F.log1p(F.greatest(F.col(c), F.lit(0.0))))
        dev = (v - F.col(f"_st_{c}.mean")) / F.col(f"_st_{c}.std")
        flags.append(F.when(F.abs(dev) > 3, F.lit(c)))
    for c in COUNTS:
        flags.append(F.when(F.col(c) > F.col(f"_st_{c}.max"), F.lit(c)))
    for c in CATEGORICAL:
        lv = levels.filter(F.col("column") == c).select(F.col("level").alias(f"_lv_{c}"), F.col("n").alias(f"_n_{c}"))
        x = x.join(F.broadcast(lv), F.col(c).cast("string") == F.col(f"_lv_{c}"), "left").drop(f"_lv_{c}")
        flags.append(F.when(F.col(f"_n_{c}").isNull(), F.lit(c)))
    rare = [F.when((F.col(f"_n_{c}") > 0) & (F.col(f"_n_{c}") < min_frequency),
                   F.concat(F.lit(f"{c} '"), F.col(c).cast("string"), F.lit("' had only "),
                            F.col(f"_n_{c}").cast("string"), F.lit(" training rows"))) for c in CATEGORICAL]
    out = x.withColumn("drift_inputs", F.array_compact(F.array(*flags))).withColumn(
        "rare_notes", F.array_compact(F.array(*rare)))
    return out.drop(*[f"_st_{c}" for c in NUMERIC_LOG + COUNTS], *[f"_n_{c}" for c in CATEGORICAL])


@query("sco07_drift_flags", f"""
WITH st AS ({_drift_sql_numeric()}),
lv AS ({" UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS level, count(*) AS n FROM f_itrain GROUP BY 2"
                           for c in CATEGORICAL)}),
x AS (SELECT t.*,
        list_filter([{", ".join(f"CASE WHEN t.{c} IS NOT NULL AND abs((ln(1 + greatest(t.{c}, 0.0)) - (SELECT mean FROM st WHERE \"column\" = '{c}'))"
                                f" / (SELECT std FROM st WHERE \"column\" = '{c}')) > 3 THEN '{c}' END" for c in NUMERIC_LOG)},
                     {", ".join(f"CASE WHEN t.{c} > (SELECT max FROM st WHERE \"column\" = '{c}') THEN '{c}' END" for c in COUNTS)},
                     {", ".join(f"CASE WHEN NOT EXISTS (SELECT 1 FROM lv WHERE lv.col = '{c}' AND lv.level = CAST(t.{c} AS VARCHAR))"
                                f" THEN '{c}' END" for c in CATEGORICAL)}], lambda e: e IS NOT NULL) AS drift_inputs
      FROM f_itest t)
SELECT array_to_string(drift_inputs, ',') AS drift_inputs, count(*) AS n FROM x GROUP BY 1
""")
def sco07_drift_flags(spark, sf):
    """SCO-7: hold-out rows by their list of drifted inputs (3 sd on the log scale, above the max count,
    unseen level)."""
    train, test = item_split(market(spark, sf))
    f = drift_flags(test, drift_stats(train), level_counts(train))
    return f.groupBy(F.concat_ws(",", "drift_inputs").alias("drift_inputs")).agg(F.count(F.lit(1)).alias("n"))


@query("sco08_rare_level_notes", f"""
WITH lv AS ({" UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS level, count(*) AS n FROM f_itrain GROUP BY 2"
                                for c in CATEGORICAL)})
SELECT col AS "column", count(*) AS rare_levels, sum(n) AS training_rows FROM lv WHERE n > 0 AND n < 20 GROUP BY 1
""")
def sco08_rare_level_notes(spark, sf, min_frequency: int = 20):
    """SCO-8 / PRE-3: levels seen in training fewer than 20 times (pooled by the encoder; noted when scored)."""
    train, _ = item_split(market(spark, sf))
    lv = level_counts(train).filter((F.col("n") > 0) & (F.col("n") < min_frequency))
    return lv.groupBy("column").agg(F.count(F.lit(1)).alias("rare_levels"), F.sum("n").alias("training_rows"))


@query("sco12_input_ranges", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round_even(quantile_cont({c}, 0.001), 6) AS p001, "
    f"round_even(quantile_cont({c}, 0.999), 6) AS p999, round_even(median({c}), 6) AS median FROM f_itrain"
    for c in NUMERIC_LOG + COUNTS))
def sco12_input_ranges(spark, sf):
    """SCO-12: input ranges and defaults: 0.1% and 99.9% quantiles and the median of each numeric input."""
    train, _ = item_split(market(spark, sf))
    cols = NUMERIC_LOG + COUNTS
    q = exact_quantiles(train, {f"{c}__{n}": (c, p) for c in cols for n, p in (("p001", 0.001), ("p999", 0.999), ("median", 0.5))})
    return q.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), *[r(f"{c}__{n}", 6).alias(n) for n in ("p001", "p999", "median")]) for c in cols])
    ).alias("e")).select("e.*")


# ---------------------------------------------------------------- SCO-3 percentile, SCO-9/10 what-if grids
@query("sco03_score_percentile", """
WITH ref AS (SELECT quantile_cont(s, [""" + ", ".join(f"{k / 100.0}" for k in range(101)) + """]) AS qs FROM f_test),
x AS (SELECT t.order_id, t.s, ref.qs FROM f_test t, ref),
b AS (SELECT order_id, s, qs, len(list_filter(qs, lambda v: v <= s)) AS i FROM x)
SELECT order_id, round_even(CASE WHEN i = 0 THEN 0.0 WHEN i >= 101 THEN 100.0
                                 WHEN qs[i + 1] = qs[i] THEN i - 1.0
                                 ELSE (i - 1) + (s - qs[i]) / (qs[i + 1] - qs[i]) END, 6) AS percentile
FROM b
""")
def sco03_score_percentile(spark, sf):
    """SCO-3: percentile of each score against 101 stored reference quantiles, by linear interpolation
    (``np.interp``): the quantile array is one broadcast row, the bracket is found with ``filter``."""
    _, test = split(market(spark, sf))
    qs = [k / 100.0 for k in range(101)]
    ref = exact_quantiles(test, {f"q{k}": ("s", q) for k, q in enumerate(qs)}).select(
        F.array(*[f"q{k}" for k in range(101)]).alias("qs"))
    x = attach(test.select("order_id", "s"), ref)
    i = F.size(F.filter("qs", lambda v: v <= F.col("s")))
    lo, hi = F.element_at("qs", i.cast("int")), F.element_at("qs", (i + 1).cast("int"))
    pct = (F.when(i == 0, F.lit(0.0)).when(i >= 101, F.lit(100.0)).when(hi == lo, i - 1.0)
           .otherwise((i - 1) + (F.col("s") - lo) / (hi - lo)))
    return x.select("order_id", r(pct, 6).alias("percentile"))


@query("sco09_promise_what_if", """
WITH g AS (SELECT t.order_id, d AS promise,
                  round_even(least(greatest(0.05::DOUBLE + coalesce(t.distance_km, 1000.0::DOUBLE) / 10000.0::DOUBLE
                      + (30.0::DOUBLE - d) / 100.0::DOUBLE - 0.02::DOUBLE * t.same_state, 0.0), 1.0), 3) AS risk
           FROM f_test t, (SELECT unnest(range(3, 61)) AS d) ds)
SELECT order_id, min(promise) FILTER (WHERE risk < 0.3) AS smallest_safe_promise, round_even(max(risk), 6) AS risk_at_3,
       round_even(min(risk), 6) AS risk_at_60 FROM g GROUP BY 1
""")
def sco09_promise_what_if(spark, sf, line: float = 0.3):
    """SCO-9 / UDF-4: each test order re-scored under promises of 3..60 days (``explode(sequence)``); the
    smallest promise whose risk falls below the line."""
    _, test = split(market(spark, sf))
    from ..functions.columns import clip
    def risk(promise):
        raw = (F.lit(0.05) + F.coalesce("distance_km", F.lit(1000.0)) / F.lit(10000.0)
               + (F.lit(30.0) - promise.cast("double")) / F.lit(100.0) - F.lit(0.02) * F.col("same_state"))
        return r(clip(raw, 0.0, 1.0), 3)

    # the grid stays inside the order's row: nothing is exploded or shuffled
    grid = F.transform(F.sequence(F.lit(3), F.lit(60)), lambda p: F.struct(p.alias("promise"), risk(p).alias("risk")))
    g = test.select("order_id", grid.alias("g"))
    safe = F.filter("g", lambda x: x["risk"] < line)
    return g.select("order_id", F.array_min(F.transform(safe, lambda x: x["promise"])).alias("smallest_safe_promise"),
                    r(F.array_max(F.transform("g", lambda x: x["risk"])), 6).alias("risk_at_3"),
                    r(F.array_min(F.transform("g", lambda x: x["risk"])), 6).alias("risk_at_60"))


@query("sco10_freight_curves", """
WITH q AS (SELECT * FROM f_audit WHERE p_a = 1),
w AS (SELECT q.order_id, q.order_item_id, 'weight' AS curve, k, 0.1 * pow(1.5, k) AS x,
             greatest(9.614 + 1.846 * (0.1 * pow(1.5, k)) + 0.811 * q.distance_km / 100 + -3.985 * q.same_state, 0.0) AS est
      FROM q, (SELECT unnest(range(0, 15)) AS k) ks),
d AS (SELECT q.order_id, q.order_item_id, 'distance' AS curve, k, 100.0 * k AS x,
             greatest(9.614 + 1.846 * q.chargeable_kg + 0.811 * (100.0 * k) / 100 + -3.985 * q.same_state, 0.0) AS est
      FROM q, (SELECT unnest(range(0, 31)) AS k) ks)
SELECT curve, k, round_even(avg(x), 6) AS x, round_even(avg(est), 6) AS mean_estimate, count(*) AS n
FROM (SELECT * FROM w UNION ALL SELECT * FROM d) GROUP BY 1, 2
""")
def sco10_freight_curves(spark, sf):
    """SCO-10 / UDF-4: estimate curves of the flagged lines over a geometric weight grid (0.1 x 1.5^k kg) and a
    linear distance grid (100 km steps): each line exploded over the grid and re-priced."""
    q = audited(market(spark, sf)).filter(F.col("p_a") == 1)
    wgt = q.select("distance_km", "same_state", F.lit("weight").alias("curve"),
                   F.explode(F.sequence(F.lit(0), F.lit(14))).alias("k")).withColumn(
        "x", F.lit(0.1) * F.pow(F.lit(1.5), F.col("k")))
    wgt = wgt.withColumn("est", tariff(F.col("x"), F.col("distance_km"), F.col("same_state")))
    dst = q.select("chargeable_kg", "same_state", F.lit("distance").alias("curve"),
                   F.explode(F.sequence(F.lit(0), F.lit(30))).alias("k")).withColumn(
        "x", F.lit(100.0) * F.col("k"))
    dst = dst.withColumn("est", tariff(F.col("chargeable_kg"), F.col("x"), F.col("same_state")))
    u = wgt.select("curve", "k", "x", "est").unionByName(dst.select("curve", "k", "x", "est"))
    return u.groupBy("curve", "k").agg(r(F.avg("x"), 6).alias("x"), r(F.avg("est"), 6).alias("mean_estimate"),
                                       F.count(F.lit(1)).alias("n"))


@query("str06_scoring_batch_twin", f"""
WITH {_RECORDS_SQL}
SELECT CASE WHEN len(errors) = 0 THEN 'scored' ELSE 'rejected' END AS outcome, count(*) AS n,
       round_even(avg(CASE WHEN len(errors) = 0 AND distance_km IS NOT NULL THEN greatest(9.614 + 1.846 * chargeable_kg
                      + 0.811 * distance_km / 100 + -3.985 * same_state, 0.0) END), 6) AS mean_estimate
FROM v GROUP BY 1
""")
def str06_scoring_batch_twin(spark, sf):
    """STR-6 (batch twin): the hold-out records validated and priced by the micro-batch body of the
    streaming scoring job; scored and rejected counts and the mean estimate."""
    from ..streaming.scoring import score_batch
    m = market(spark, sf)
    scored, rejected = score_batch(freight_records(m), _states(m))
    a = scored.agg(F.lit("scored").alias("outcome"), F.count(F.lit(1)).alias("n"),
                   r(F.avg("estimate"), 6).alias("mean_estimate"))
    b = rejected.agg(F.lit("rejected").alias("outcome"), F.count(F.lit(1)).alias("n"),
                     F.lit(None).cast("double").alias("mean_estimate"))
    return a.unionByName(b)


def _landed(spark, m):
    """The hold-out records as a landing folder, and fresh folders for output and checkpoint."""
    records = stored(freight_records(m).repartition(16), "landing")
    base = f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    return records, records.inputFiles()[0].rsplit("/", 1)[0], f"{base}/out", f"{base}/checkpoint"


ORACLE["str06_stream_scoring"] = ORACLE["str06_scoring_batch_twin"]


@query("str06_stream_scoring")
def str06_stream_scoring(spark, sf):
    """STR-6: the hold-out records validated, priced and logged by a stream; counts and means from what it wrote."""
    from ..streaming.scoring import run_scoring_stream
    m = market(spark, sf)
    records, landing, out, check = _landed(spark, m)
    run_scoring_stream(spark, landing, records.schema, _states(m), out, check, files=4)
    log = spark.read.schema("id string, status int, fair_freight double, epoch int").parquet(f"{out}/log")
    outcome = F.when(F.col("status") == 200, F.lit("scored")).otherwise(F.lit("rejected"))
    return log.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"), r(F.avg("fair_freight"), 6).alias("mean_estimate"))


@query("str06_stream_saved_model", f"""
WITH {_RECORDS_SQL}
SELECT CASE WHEN len(errors) = 0 THEN 'scored' ELSE 'rejected' END AS outcome, count(*) AS n, CAST(0 AS BIGINT) AS differing
FROM v GROUP BY 1
""")
def str06_stream_saved_model(spark, sf):
    """STR-6 / SNK-4: the stream with a saved pipeline (ridge), loaded from its folder; rows whose estimate in the log differs
    from the batch scores of the same model, or that only one of the two has."""
    from ..operators.models import Bench, Fitted
    from ..streaming.scoring import run_scoring_stream, score_batch
    from .q_models import FS_A
    m = market(spark, sf)
    records, landing, out, check = _landed(spark, m)
    bench = Bench(item_split(m)[0], FS_A, "reg_target")
    bench.ridge(10.0).save(spark, f"{out}/model")
    bench.close()
    model = Fitted.load(spark, f"{out}/model")
    run_scoring_stream(spark, landing, records.schema, _states(m), out, check, model, files=4)
    log = spark.read.schema("id string, status int, fair_freight double, epoch int").parquet(f"{out}/log")
    scored, rejected = score_batch(records, _states(m), model)
    batch = scored.select("id", F.lit(200).alias("_status"), "estimate").unionByName(
        rejected.select("id", F.lit(422).alias("_status"), F.lit(None).cast("double").alias("estimate")))
    both = log.join(batch, "id", "full")
    same = F.col("status").eqNullSafe(F.col("_status")) & (F.col("fair_freight").eqNullSafe(F.col("estimate")) | F.coalesce(
        F.abs(F.col("fair_freight") - F.col("estimate")) < 1e-9, F.lit(False)))
    outcome = F.when(F.coalesce("status", "_status") == 200, F.lit("scored")).otherwise(F.lit("rejected"))
    return both.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(~same, F.lit(1))).alias("differing"))
