"""Statistics, histograms, splits, scales and names over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rasterloom.functions import names, radiometry
from rasterloom.operators import labels, stats
from rasterloom.plans import fixtures as fx
from rasterloom.plans.registry import Registry

catalog = Registry()
query = catalog.query

_BANDS = {"HH": "l_quantity", "HV": "l_extendedprice"}
_CHANNELS = """ch AS (SELECT l_suppkey AS product, l_linenumber AS spacing, 'HH' AS channel, l_quantity AS x FROM lineitem
    UNION ALL SELECT l_suppkey, l_linenumber, 'HV', l_extendedprice FROM lineitem)"""
_FIGURES = """count(x) AS n, round(sum(x), 2) AS sum, round(sum(x * x), 0) AS sum_sq, min(x) AS min, max(x) AS max,
    round(avg(x), 6) AS mean, round(stddev_pop(x), 4) AS std"""


def _channel_rows(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "lineitem").selectExpr("l_suppkey as product", "l_linenumber as spacing", "l_quantity", "l_extendedprice")
    return stats.channels(rows, _BANDS, ["product", "spacing"])


def _figures(partials, *keys):
    out = stats.finalize(partials)
    return out.select(*keys, "n", F.round("sum", 2).alias("sum"), F.round("sum_sq", 0).alias("sum_sq"), "min", "max", F.round("mean", 6).alias("mean"), F.round("std", 4).alias("std"))


@query(f"WITH {_CHANNELS} SELECT channel, spacing, {_FIGURES} FROM ch GROUP BY channel, spacing")
def channel_stats(spark, sf_dir):
    keys = ["channel", "spacing"]
    return _figures(stats.partial_stats(_channel_rows(spark, sf_dir), keys), *keys)


@query(f"WITH {_CHANNELS} SELECT product, channel, {_FIGURES} FROM ch GROUP BY product, channel")
def channel_stats_by_product(spark, sf_dir):
    keys = ["product", "channel"]
    return _figures(stats.partial_stats(_channel_rows(spark, sf_dir), keys), *keys)


@query(f"WITH {_CHANNELS} SELECT channel, spacing, {_FIGURES} FROM ch GROUP BY channel, spacing")
def two_level_stats_merge(spark, sf_dir):
    keys = ["channel", "spacing"]
    partials = stats.partial_stats(_channel_rows(spark, sf_dir), ["product", *keys])
    return _figures(stats.merge_stats(partials, keys), *keys)


@query(f"""WITH {_CHANNELS}, f AS (SELECT channel, spacing, min(x) AS lo, max(x) AS hi FROM ch GROUP BY channel, spacing)
    SELECT channel, string_agg(spacing || ':' || lo || '..' || hi, ',' ORDER BY spacing) AS ranges FROM f GROUP BY channel""")
def stats_ranges_text(spark, sf_dir):
    """Ranges by spacing as one text a channel (spacings are few)."""
    rows = stats.partial_stats(_channel_rows(spark, sf_dir), ["channel", "spacing"])
    parts = F.array_sort(F.collect_list(F.struct("spacing", F.concat("spacing", F.lit(":"), "min", F.lit(".."), "max").alias("t"))))
    return rows.groupBy("channel").agg(F.array_join(F.transform(parts, lambda p: p["t"]), ",").alias("ranges"))


_MONTHS = ", ".join(f"(SELECT count(*) FILTER (month(o_orderdate) = {i + 1}) FROM orders) AS {name.lower()}" for i, name in enumerate(stats.MONTHS))


@query(f"""WITH {_CHANNELS}, f AS (SELECT channel, spacing::VARCHAR AS spacing, avg(x) AS mean, stddev_pop(x) AS std, min(x) AS lo, max(x) AS hi FROM ch GROUP BY channel, spacing)
    SELECT channel, spacing, round(mean, 4) AS mean, round(std, 4) AS std, lo AS "min", hi AS "max", {_MONTHS} FROM f""")
def stats_nested_json(spark, sf_dir):
    """The report as one JSON document, read back from its text."""
    rows = stats.finalize(stats.partial_stats(_channel_rows(spark, sf_dir), ["channel", "spacing"]))
    report = stats.document(rows, stats.month_histogram(fx.table(spark, sf_dir, "orders"), F.col("o_orderdate")))
    text = report.select(F.to_json(F.struct("channels", "acquisition_month_histogram")).alias("json"))
    figures = "map<string,map<string,struct<mean:double,std:double,min:double,max:double>>>"
    months = ",".join(f"{m}:bigint" for m in stats.MONTHS)
    back = text.select(F.from_json("json", f"channels {figures}, acquisition_month_histogram struct<{months}>").alias("d"))
    back = back.select(F.explode("d.channels").alias("channel", "s"), "d.acquisition_month_histogram").select("channel", F.explode("s").alias("spacing", "f"), "acquisition_month_histogram")
    return back.select(
        "channel", "spacing", F.round("f.mean", 4).alias("mean"), F.round("f.std", 4).alias("std"), "f.min", "f.max",
        *[F.col(f"acquisition_month_histogram.{m}").alias(m.lower()) for m in stats.MONTHS],
    )


@query("""SELECT m::INTEGER AS month, count(o_orderdate) AS n FROM range(1, 13) t(m) LEFT JOIN orders ON month(o_orderdate) = m GROUP BY m""")
def month_histogram(spark, sf_dir):
    return stats.month_histogram(fx.table(spark, sf_dir, "orders"), F.col("o_orderdate"))


@query("SELECT o_orderkey, month(o_orderdate)::INTEGER AS month, (dayofyear(o_orderdate) - 1)::INTEGER AS day FROM orders")
def day_of_year(spark, sf_dir):
    ts = F.col("o_orderdate")
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", F.month(ts).alias("month"), names.day_index(ts).alias("day"))


@query(f"WITH {fx.SCENES} SELECT scene, label, count(*) AS n FROM sc WHERE label < 6 GROUP BY scene, label")
def class_histogram_scene(spark, sf_dir):
    return labels.class_counts(fx.scene_pixels(spark, sf_dir))


_DENSE = f"""{fx.SCENES}, cnt AS (SELECT scene, label, count(*) AS n FROM sc WHERE label < 6 GROUP BY scene, label),
    full_grid AS (SELECT s.scene, k::INTEGER AS label, coalesce(cnt.n, 0) AS n FROM (SELECT DISTINCT scene FROM sc) s
        CROSS JOIN range(6) t(k) LEFT JOIN cnt ON cnt.scene = s.scene AND cnt.label = k)"""


def _dense(spark, sf_dir):
    pixels = fx.scene_pixels(spark, sf_dir)
    return labels.dense_counts(pixels, labels.class_counts(pixels))


@query(f"WITH {_DENSE} SELECT scene, label, n FROM full_grid")
def class_histogram_dense(spark, sf_dir):
    return _dense(spark, sf_dir)


@query(f"""WITH {_DENSE} SELECT label, sum(n)::BIGINT AS pixels, count(*) FILTER (n > 0) AS scenes,
    round(100.0::DOUBLE * sum(n) / sum(sum(n)) OVER (), 6) AS pixel_percentage FROM full_grid GROUP BY label""")
def class_percentages(spark, sf_dir):
    return labels.percentages(_dense(spark, sf_dir)).withColumn("pixel_percentage", F.round("pixel_percentage", 6))


@query(f"WITH {_DENSE} SELECT scene, list(label ORDER BY label) FILTER (n > 0) AS present FROM full_grid GROUP BY scene HAVING bool_or(n > 0)")
def scene_presence(spark, sf_dir):
    counts = labels.class_counts(fx.scene_pixels(spark, sf_dir))
    return counts.groupBy("scene").agg(F.array_sort(F.collect_set("label")).alias("present"))


def _split_sql(scene: str, percentage: int) -> str:
    return f"""{fx.SCENES},
    wi AS (SELECT {scene} AS id, count(*) FILTER (label = 0) AS water, count(*) FILTER (label = 1) AS ice FROM sc GROUP BY 1),
    scored AS (SELECT *, CASE WHEN water + ice > 0 THEN abs(water::DOUBLE / (water + ice) - 0.5::DOUBLE) ELSE 1.0::DOUBLE END AS score FROM wi),
    best AS (SELECT (SELECT id FROM scored WHERE water > 0 AND ice > 0 ORDER BY score, id LIMIT 1) AS both_id,
        (SELECT min(id) FROM scored WHERE water > 0) AS fw, (SELECT min(id) FROM scored WHERE ice > 0) AS fi, (SELECT count(*) FROM scored) AS n),
    placed AS (SELECT id, water, ice, n, row_number() OVER (ORDER BY
        CASE WHEN both_id IS NOT NULL THEN CASE WHEN id = both_id THEN 0 ELSE 2 END WHEN id = fw THEN 0 WHEN id = fi THEN 1 ELSE 2 END, score DESC, id) AS p
        FROM scored, best),
    parts AS (SELECT id, water, ice, CASE WHEN p <= n - CASE WHEN n > 1 THEN least(greatest(1, n * {percentage} // 100), n - 1) ELSE 1 END THEN 'val' ELSE 'train' END AS split FROM placed)"""


def _split(spark, sf_dir, scene, percentage):
    count = lambda k: F.count_if(F.col("label") == k).alias("water" if k == 0 else "ice")
    return labels.split(fx.scene_pixels(spark, sf_dir).groupBy(scene.alias("id")).agg(count(0), count(1)), percentage)


@query(f"WITH {_split_sql('scene', 80)} SELECT * FROM parts")
def split_train_val(spark, sf_dir):
    return _split(spark, sf_dir, F.col("scene"), 80)


@query(f"WITH {_split_sql('scene * 40 + event_id % 40', 60)} SELECT * FROM parts")
def split_train_val_sparse(spark, sf_dir):
    """Scenes of which many have one class or none."""
    return _split(spark, sf_dir, F.col("scene") * 40 + F.col("event_id") % 40, 60)


@query(f"""WITH {_split_sql('scene', 80)} SELECT coalesce(split, 'total') AS split, count(*) AS scenes,
    round(100.0::DOUBLE * sum(water) / sum(water + ice), 6) AS water_percentage, round(100.0::DOUBLE * sum(ice) / sum(water + ice), 6) AS ice_percentage
    FROM parts GROUP BY ROLLUP (split)""")
def split_summary(spark, sf_dir):
    out = labels.split_summary(_split(spark, sf_dir, F.col("scene"), 80))
    return out.withColumns({c: F.round(c, 6) for c in ("water_percentage", "ice_percentage")})


@query(f"""WITH {_split_sql('scene', 80)}, full_grid AS (SELECT s.id AS scene, k::INTEGER AS label, coalesce(c.n, 0) AS n FROM parts s CROSS JOIN range(6) t(k)
        LEFT JOIN (SELECT scene, label, count(*) AS n FROM sc WHERE label < 6 GROUP BY 1, 2) c ON c.scene = s.id AND c.label = k),
    cl AS (SELECT label, 100.0::DOUBLE * sum(n) / sum(sum(n)) OVER () AS p, count(*) FILTER (n > 0) AS s FROM full_grid GROUP BY label)
    SELECT count(*) AS n_scenes, count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'val') AS n_val, 80 AS train_percentage, 20 AS val_percentage,
        (SELECT string_agg(round(p, 4)::DECIMAL(18, 4), ',' ORDER BY label) FROM cl) AS pixel_percentages, (SELECT string_agg(s, ',' ORDER BY label) FROM cl) AS scene_counts,
        round(100.0::DOUBLE * sum(water) FILTER (split = 'train') / sum(water + ice) FILTER (split = 'train'), 6) AS train_water,
        round(100.0::DOUBLE * sum(ice) FILTER (split = 'val') / sum(water + ice) FILTER (split = 'val'), 6) AS val_ice,
        string_agg(id::VARCHAR, ',' ORDER BY id::VARCHAR) FILTER (split = 'train') AS train_scenes, string_agg(id::VARCHAR, ',' ORDER BY id::VARCHAR) FILTER (split = 'val') AS val_scenes FROM parts""")
def split_document(spark, sf_dir):
    """The split's report, maps and lists as texts."""
    out = labels.split_document(_split(spark, sf_dir, F.col("scene"), 80), _dense(spark, sf_dir), 80)
    joined = lambda c, kind: F.array_join(F.transform(F.map_values(c), lambda x: x.cast(kind).cast("string")), ",")
    return out.select(
        "n_scenes", "n_train", "n_val", "train_percentage", "val_percentage", joined("total_pixel_percentages_all_classes", "decimal(18,4)").alias("pixel_percentages"),
        joined("scene_counts_all_classes", "long").alias("scene_counts"), F.round("train_pixel_percentages_balance_classes.WATER", 6).alias("train_water"),
        F.round("val_pixel_percentages_balance_classes.ICE", 6).alias("val_ice"), F.array_join("train_scenes", ",").alias("train_scenes"), F.array_join("val_scenes", ",").alias("val_scenes"),
    )


@query("SELECT l_orderkey, l_linenumber, round(pow(10::DOUBLE, -l_quantity / 10), 9) AS linear FROM lineitem")
def db_to_linear(spark, sf_dir):
    return fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(radiometry.db_to_linear(-F.col("l_quantity")), 9).alias("linear"))


@query("SELECT l_orderkey, l_linenumber, round(10 * log10(greatest(l_discount, 1e-12::DOUBLE)), 6) AS db FROM lineitem")
def linear_to_db(spark, sf_dir):
    return fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(radiometry.linear_to_db(F.col("l_discount")), 6).alias("db"))


@query(f"""WITH {fx.RAS}, ch AS (SELECT 'discount' AS name, l_discount AS x FROM lineitem UNION ALL
        SELECT 'discount_db', 10 * log10(l_discount) FROM lineitem WHERE l_discount > 0 UNION ALL
        SELECT 'price', l_extendedprice FROM lineitem UNION ALL SELECT 'ras', v FROM ras),
    p AS (SELECT name, min(x) AS lo, quantile_cont(x, 0.01) AS p1, quantile_cont(x, 0.5) AS mid, quantile_cont(x, 0.99) AS p99, max(x) AS hi FROM ch GROUP BY name)
    SELECT name, CASE WHEN mid < 0 AND p1 < -5 AND p99 < 50 AND lo < 0 THEN 'db' WHEN lo >= 0 AND mid < 1 AND p99 < 5 THEN 'linear'
        WHEN lo >= 0 AND (mid > 10 OR p99 > 100 OR hi > 255) THEN 'dn' ELSE 'unknown' END AS scale, round(p1, 6) AS p1, round(mid, 6) AS median, round(p99, 6) AS p99 FROM p""")
def sar_scale_classify(spark, sf_dir):
    items = fx.table(spark, sf_dir, "lineitem")
    rows = stats.channels(items, {"discount": "l_discount", "price": "l_extendedprice"}, []).withColumnRenamed("channel", "name")
    db = items.where("l_discount > 0").select(F.lit("discount_db").alias("name"), radiometry.linear_to_db(F.col("l_discount")).alias("x"))
    rows = rows.unionByName(db).unionByName(fx.ras(spark, sf_dir).select(F.lit("ras").alias("name"), F.col("v").alias("x")))
    found = stats.exact_percentiles(rows, ["name"], "x", radiometry.SCALE_PLACES)
    at = lambda i: F.round(F.get("p", F.lit(i)), 6)
    return found.select("name", radiometry.scale_of(F.col("p")).alias("scale"), at(1).alias("p1"), at(2).alias("median"), at(3).alias("p99"))


_M, _S = radiometry.BAND_MEAN, radiometry.BAND_STD


@query(f"""WITH {fx.TWO}, m AS (SELECT row, col, CASE WHEN row % 50 = 49 THEN NULL ELSE hh * 10 - 17 END AS hh, hv * 10 - 28 AS hv FROM two)
    SELECT row, col, round((coalesce(hh, {_M['hh']}::DOUBLE) - {_M['hh']}::DOUBLE) / ({_S['hh']}::DOUBLE + 1e-12::DOUBLE), 6) AS hh,
        round((hv - {_M['hv']}::DOUBLE) / ({_S['hv']}::DOUBLE + 1e-12::DOUBLE), 6) AS hv FROM m""")
def standardize_bands(spark, sf_dir):
    rows = fx.two(spark, sf_dir).withColumn("hh", F.when(F.col("row") % 50 == 49, F.lit(float("nan"))).otherwise(F.col("hh") * 10 - 17))
    rows = rows.withColumn("hv", F.col("hv") * 10 - 28)
    return rows.select("row", "col", *[F.round(radiometry.standardize(F.col(b), _M[b], _S[b]), 6).alias(b) for b in ("hh", "hv")])


@query(f"""WITH {fx.TWO}, t AS (SELECT *, row // 16 AS tile FROM two), r AS (SELECT tile, min(hh) AS lo, max(hh) AS hi FROM t WHERE row % 50 <> 49 GROUP BY tile)
    SELECT row, col, tile, CASE WHEN row % 50 <> 49 THEN round((hh - lo) / (hi - lo + 1e-8::DOUBLE), 6) END AS hh FROM t JOIN r USING (tile)""")
def minmax_patch(spark, sf_dir):
    rows = fx.two(spark, sf_dir).withColumn("tile", F.floor(F.col("row") / 16)).withColumn("hh", F.when(F.col("row") % 50 != 49, F.col("hh")))
    w = W.partitionBy("tile")
    return rows.select("row", "col", "tile", F.round(radiometry.minmax(F.col("hh"), F.min("hh").over(w), F.max("hh").over(w)), 6).alias("hh"))


@query("""SELECT c_custkey, regexp_extract(rtrim(p, '/\\'), '[^/\\\\]*$') AS name, s || 'm' AS tag, lpad(c_custkey::VARCHAR, 5, '0') AS patch
    FROM (SELECT c_custkey, 'data/' || c_name || '/' AS p, (c_nationkey / 2)::VARCHAR AS s0, CASE WHEN c_nationkey % 2 = 0 THEN (c_nationkey // 2)::VARCHAR ELSE (c_nationkey / 2)::VARCHAR END AS s
    FROM customer)""")
def product_names(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "customer")
    path = F.concat(F.lit("data/"), "c_name", F.lit("/"))
    return rows.select("c_custkey", names.basename(path).alias("name"), names.spacing_tag(F.col("c_nationkey") / 2).alias("tag"), names.patch_name(F.col("c_custkey")).alias("patch"))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def product_label_anti(spark, sf_dir):
    """Products without an annotation."""
    marked = fx.table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    return fx.table(spark, sf_dir, "orders").join(marked, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select("o_orderkey", "o_orderpriority")


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def product_label_semi(spark, sf_dir):
    return fx.table(spark, sf_dir, "customer").join(fx.table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")
