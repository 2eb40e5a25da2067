"""The same results as plain SQL for DuckDB, written against the tables."""

from __future__ import annotations

from platelake.schemas import COLOUR_MAP, PIXEL_STATS

WELLS = """wells AS (
SELECT o_orderkey AS id_code,
  CASE WHEN o_custkey % 4 = 0 THEN 'test' ELSE 'train' END AS dataset,
  concat(CASE o_custkey % 4 WHEN 0 THEN 'HUVEC' WHEN 1 THEN 'U2OS' WHEN 2 THEN 'RPE'
         ELSE 'HEPG2' END, '-', lpad(CAST(o_custkey % 9 + 1 AS VARCHAR), 2, '0')) AS experiment,
  CAST(o_orderkey % 4 + 1 AS INT) AS plate,
  concat(chr(CAST(66 + o_orderkey % 14 AS INT)),
         lpad(CAST(o_orderkey % 22 + 2 AS VARCHAR), 2, '0')) AS well,
  CASE WHEN o_orderkey % 10 = 0 THEN 'negative_control'
       WHEN o_orderkey % 10 = 1 THEN 'positive_control' ELSE 'treatment' END AS well_type,
  CASE WHEN o_custkey % 4 = 0 AND o_orderkey % 10 > 1 THEN NULL
       ELSE o_orderkey % 1108 END AS sirna
FROM orders)"""

SITES = WELLS + """, sites AS (
SELECT id_code, dataset, experiment, split_part(experiment, '-', 1) AS cell_type, plate, well,
  well_type, sirna, site
FROM wells, (SELECT unnest([1, 2]) AS site) s),
treated AS (SELECT * FROM sites WHERE well_type = 'treatment')"""

PATH = ("concat('images/', dataset, '/', experiment, '/Plate', CAST(plate AS VARCHAR), '/', well,"
        " '_s', CAST(site AS VARCHAR), '_w', CAST(channel AS VARCHAR), '.png')")

FILES = SITES + f""", site_channels AS (
SELECT *, {PATH} AS path
FROM (SELECT *, unnest([1, 2, 3, 4, 5, 6]) AS channel,
      unnest([0, 1, 2, 3, 4, 5]) AS channel_pos FROM treated) t),
inventory AS (
SELECT DISTINCT path FROM site_channels WHERE substring(md5(path), 1, 2) <> '00'
UNION ALL SELECT 'images/train/notes.txt')"""

KEYED = SITES + """, copied AS (
SELECT *, row_number() OVER (PARTITION BY id_code, dataset, experiment, cell_type, plate, well,
  well_type, sirna, site) - 1 AS copy FROM treated),
keyed AS (
SELECT c.*, s.seed, md5(concat_ws('|', CAST(s.seed AS VARCHAR), dataset, experiment,
  CAST(plate AS VARCHAR), well, CAST(site AS VARCHAR), CAST(id_code AS VARCHAR),
  CAST(NULLIF(copy, 0) AS VARCHAR))) AS key
FROM copied c, (SELECT CAST(unnest([{seeds}]) AS BIGINT) AS seed) s),
random_plan AS (
SELECT 'random' AS strategy, seed, dataset, concat('random-', CAST(seed AS VARCHAR), '/', dataset,
  '/', printf('%03d', (rn - 1) // 308 + 1)) AS dest_path,
  (rn - 1) % 308 + 1 AS pos, id_code, site
FROM (SELECT *, row_number() OVER (PARTITION BY seed, dataset
  ORDER BY key, id_code, site, cell_type NULLS FIRST, well_type NULLS FIRST, sirna NULLS FIRST) AS rn
  FROM keyed) r),
grouped_plan AS (
SELECT 'by_exp_plate_site' AS strategy, seed, dataset,
  concat('by_exp_plate_site-', CAST(seed AS VARCHAR), '/', experiment, '_p',
  CAST(plate AS VARCHAR), '_s', CAST(site AS VARCHAR)) AS dest_path,
  row_number() OVER (PARTITION BY seed, dataset, experiment, plate, site
  ORDER BY key, id_code, cell_type NULLS FIRST, well_type NULLS FIRST, sirna NULLS FIRST) AS pos,
  id_code, site
FROM keyed)"""

PLAN = "seed, dataset, dest_path, pos, id_code, site"


def _plans(seeds: str) -> str:
    return KEYED.replace("{seeds}", seeds)


PIXELS = """pixels AS (
SELECT CAST(vec_id // 6 AS BIGINT) AS site_id, CAST(vec_id % 6 + 1 AS INT) AS channel,
  CAST(p AS INT) AS px, CAST(floor(abs(CAST(v AS DOUBLE)) * 1000) AS INT) % 256 AS val
FROM (SELECT vec_id, unnest(range(0, 64)) AS p, unnest(embedding) AS v FROM embeddings) e)"""

COLOURS = "colours(channel, red, green, blue, low, high) AS (VALUES " + ", ".join(
    str(row) for row in COLOUR_MAP) + ")"
STATS = "stats(channel, mean, std) AS (VALUES " + ", ".join(
    f"({c}, CAST({m} AS DOUBLE), CAST({s} AS DOUBLE))" for c, m, s in PIXEL_STATS) + ")"

# A copy of a plane changes nothing: the largest one stands for it.
STACKED = PIXELS + """, whole AS (
SELECT site_id FROM pixels GROUP BY site_id HAVING count(DISTINCT channel) = 6),
stacked AS (
SELECT site_id, channel, px, max(val) AS val,
  px * 6 + channel - 1 AS hwc, (channel - 1) * 64 + px AS chw, concat('W', site_id) AS well
FROM pixels WHERE site_id IN (SELECT site_id FROM whole) GROUP BY site_id, channel, px)"""

RGB_SUM = """least(255, sum(CAST(trunc(least(1.0, (val / 255.0::DOUBLE)
  / ((high - low) / 255.0::DOUBLE) + low / 255.0::DOUBLE) * {colour}) AS BIGINT)))"""


def _rgb(colour: str, source: str, keys: str) -> str:
    return (f"SELECT {keys}, CAST({RGB_SUM.format(colour=colour)} AS INT) AS v "
            f"FROM {source} JOIN colours USING (channel) GROUP BY {keys}")


LOGITS = """logits AS (
SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS l,
  CAST(label AS BIGINT) AS label FROM embeddings),
scored AS (
SELECT vec_id, l, label, list_max(l) AS top, l[label + 1] AS target,
  list_sum(list_transform(l, lambda x: exp(x - list_max(l)))) AS total FROM logits)"""

LOSS = "CASE WHEN target IS NULL THEN 0 ELSE ln(total) + top - target END"

RECORDS = STACKED + """, plane_sites AS (
SELECT DISTINCT vec_id // 6 AS id_code,
  CASE WHEN vec_id // 6 % 4 = 0 THEN 'test' ELSE 'train' END AS dataset,
  concat(CASE WHEN vec_id // 6 % 4 = 0 THEN 'HUVEC-' ELSE 'RPE-' END,
         lpad(CAST(vec_id // 6 % 3 + 1 AS VARCHAR), 2, '0')) AS experiment,
  CAST(vec_id // 6 % 2 + 1 AS INT) AS plate, concat('W', vec_id // 6) AS well, 1 AS site,
  CASE WHEN vec_id // 6 % 4 <> 0 THEN vec_id // 6 % 1108 END AS sirna
FROM embeddings),
keyed AS (
SELECT *, md5(concat_ws('|', '42', dataset, experiment, CAST(plate AS VARCHAR), well,
  CAST(site AS VARCHAR), CAST(id_code AS VARCHAR))) AS key FROM plane_sites
WHERE id_code IN (SELECT site_id FROM whole)),
placed AS (
SELECT 'random-42' AS layout, dataset, printf('%03d', (rn - 1) // 50 + 1) AS file,
  (rn - 1) % 50 + 1 AS pos, well, experiment, plate, site, sirna, id_code
FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY key, id_code) AS rn FROM keyed) r
UNION ALL
SELECT 'by_exp_plate_site-42', dataset,
  concat(experiment, '_p', CAST(plate AS VARCHAR), '_s', CAST(site AS VARCHAR)),
  row_number() OVER (PARTITION BY dataset, experiment, plate, site ORDER BY key, id_code),
  well, experiment, plate, site, sirna, id_code FROM keyed),
sums AS (
SELECT site_id AS id_code, sum(val) AS total, sum(val * (hwc + 1)) AS weighted
FROM stacked GROUP BY site_id)"""

# Planes at addresses that files can have; every fifth one may have 16 bits.
FILED = """filed AS (
SELECT DISTINCT site_id, channel, px, val, depth, pixel,
  CASE WHEN site_id // 4 % 3 = 0 THEN 'test' ELSE 'train' END AS dataset,
  concat(CASE WHEN site_id // 4 % 3 = 0 THEN 'HUVEC-' ELSE 'RPE-' END,
    lpad(CAST(site_id // 7392 * 3 + site_id // 4 % 3 + 1 AS VARCHAR), 2, '0')) AS experiment,
  CAST(site_id % 4 + 1 AS INT) AS plate,
  concat(chr(CAST(66 + site_id // 12 % 14 AS INT)),
    lpad(CAST(site_id // 168 % 22 + 2 AS VARCHAR), 2, '0')) AS well,
  CAST(site_id // 3696 % 2 + 1 AS INT) AS site
FROM (SELECT CAST(vec_id // 6 AS BIGINT) AS site_id, CAST(vec_id % 6 + 1 AS INT) AS channel,
  CAST(p AS INT) AS px, CAST(floor(abs(CAST(v AS DOUBLE)) * 1000) AS INT) % 256 AS pixel,
  CASE WHEN vec_id % 5 = 0 THEN 16 ELSE 8 END AS depth,
  CASE WHEN vec_id % 5 = 0 THEN CAST(floor(abs(CAST(v AS DOUBLE)) * 100000) AS INT) % 65536
    ELSE CAST(floor(abs(CAST(v AS DOUBLE)) * 1000) AS INT) % 256 END AS val
  FROM (SELECT vec_id, unnest(range(0, 64)) AS p, unnest(embedding) AS v FROM embeddings) e) f),
filled AS (SELECT * FROM filed WHERE site_id IN
  (SELECT site_id FROM filed GROUP BY site_id HAVING count(DISTINCT channel) = 6))"""
FILE_KEY = "dataset, experiment, plate, well, site"

SHARED_STATS = """float_pixels AS (
SELECT well, site_id, channel, hwc,
  CAST((CAST(val AS FLOAT) - CAST(mean AS FLOAT)) / CAST(std AS FLOAT) AS DOUBLE) AS f
FROM stacked JOIN stats USING (channel))"""

SITE_COLUMNS = "id_code, dataset, experiment, cell_type, plate, well, well_type, sirna, site"

PARSE = r"([^/]+)/([^/]+)/Plate([0-9]+)/([A-Z][0-9]{2})_s([0-9]+)_w([0-9]+)[.]png$"


def _group(i: int) -> str:
    return f"nullif(regexp_extract(path, '{PARSE}', {i}), '')"


PRESENCE = FILES + """, wanted AS (
SELECT dataset, experiment, plate, well, site, count(*) AS n_sites FROM treated
GROUP BY dataset, experiment, plate, well, site)"""

ORACLE = {
    "combine_metadata": f"WITH {SITES} SELECT {SITE_COLUMNS} FROM sites",
    "expand_sites": f"WITH {SITES} SELECT id_code, experiment, plate, well, site FROM sites",
    "metadata_head": f"WITH {SITES} SELECT {SITE_COLUMNS} FROM sites "
                     "ORDER BY dataset, id_code, site LIMIT 5",
    "fix_labels": f"WITH {WELLS} SELECT id_code, sirna FROM wells",
    "filter_sites": f"WITH {SITES} SELECT {SITE_COLUMNS} FROM treated WHERE dataset = 'train'",
    "select_experiments": f"WITH {SITES} SELECT {SITE_COLUMNS} FROM treated "
                          "WHERE experiment IN ('RPE-05', 'U2OS-03')",
    "site_keys": f"WITH {SITES} SELECT dataset, experiment, plate, well, site FROM sites",
    "packed_columns": f"WITH {SITES} SELECT well, well_type, experiment, plate, site, cell_type, "
                      "sirna FROM treated",
    "labelled_examples": f"WITH {SITES} SELECT id_code, dataset, site, sirna FROM treated "
                         "WHERE sirna IS NOT NULL",
    "image_paths": f"WITH {FILES} SELECT id_code, site, channel, channel_pos, path "
                   "FROM site_channels",
    "parse_image_path": f"""WITH {FILES} SELECT path, {_group(1)} AS dataset,
{_group(2)} AS experiment, CAST({_group(3)} AS INT) AS plate, {_group(4)} AS well,
CAST({_group(5)} AS INT) AS site, CAST({_group(6)} AS INT) AS channel,
{_group(6)} IS NOT NULL AS parsed FROM inventory""",
    "discover_splits": f"""WITH {FILES} SELECT DISTINCT split_part(path, '/', 2) AS dataset
FROM inventory WHERE split_part(path, '/', 2) IN ('test', 'train')""",
    "missing_images": f"""WITH {PRESENCE} SELECT dataset, experiment, plate, well, site, channel,
n_sites FROM (SELECT *, unnest([1, 2, 3, 4, 5, 6]) AS channel FROM wanted) w
WHERE {PATH} NOT IN (SELECT path FROM inventory)""",
    "complete_sites": f"""WITH {PRESENCE} SELECT dataset, experiment, plate, well, site,
any_value(n_sites) AS n_sites
FROM (SELECT *, unnest([1, 2, 3, 4, 5, 6]) AS channel FROM wanted) w
WHERE {PATH} IN (SELECT path FROM inventory)
GROUP BY dataset, experiment, plate, well, site HAVING count(*) = 6""",
    "pack_random": f"WITH {_plans('42')} SELECT {PLAN} FROM random_plan",
    "pack_by_group": f"WITH {_plans('42')} SELECT {PLAN} FROM grouped_plan",
    "pack_multi_seed": f"WITH {_plans('42, 7')} SELECT strategy, {PLAN} FROM random_plan "
                       f"UNION ALL SELECT strategy, {PLAN} FROM grouped_plan",
    "pack_manifest": f"""WITH {_plans('42')} SELECT strategy, seed, dataset, dest_path,
count(*) AS n_sites, min(pos) AS first_pos, max(pos) AS last_pos
FROM (SELECT * FROM random_plan UNION ALL SELECT * FROM grouped_plan) p
GROUP BY strategy, seed, dataset, dest_path""",
    "stack_complete_sites": f"""WITH {PIXELS} SELECT * FROM (SELECT site_id, px,
{", ".join(f"max(val) FILTER (channel = {c}) AS c{c}" for c in range(1, 7))}
FROM pixels GROUP BY site_id, px) s
WHERE {" AND ".join(f"c{c} IS NOT NULL" for c in range(1, 7))}""",
    "pixel_index": f"""WITH {PIXELS} SELECT site_id, channel, px,
CAST(px * 6 + channel - 1 AS BIGINT) AS hwc_index,
CAST((channel - 1) * 64 + px AS BIGINT) AS chw_index FROM pixels""",
    "rgb_compose": f"""WITH {PIXELS}, {COLOURS} SELECT site_id, px,
CAST({RGB_SUM.format(colour="red")} AS BIGINT) AS r,
CAST({RGB_SUM.format(colour="green")} AS BIGINT) AS g,
CAST({RGB_SUM.format(colour="blue")} AS BIGINT) AS b
FROM pixels JOIN colours USING (channel) GROUP BY site_id, px""",
    "normalize_pixels": f"""WITH {PIXELS}, {STATS} SELECT site_id, channel, px,
round((CAST(val AS DOUBLE) - mean) / std, 6) AS normalised FROM pixels JOIN stats USING (channel)""",
    "unit_scale": f"WITH {PIXELS} SELECT site_id, channel, px, "
                  "round(val / 255.0::DOUBLE, 6) AS scaled FROM pixels",
    "load_sites": f"WITH {STACKED} SELECT well, hwc AS idx, val FROM stacked",
    "channel_first_images": f"WITH {STACKED} SELECT well, chw AS idx, val FROM stacked",
    "rgb_images": f"""WITH {STACKED}, {COLOURS}
SELECT well, px * 3 AS idx, v AS val FROM ({_rgb("red", "stacked", "well, px")}) r UNION ALL
SELECT well, px * 3 + 1, v FROM ({_rgb("green", "stacked", "well, px")}) g UNION ALL
SELECT well, px * 3 + 2, v FROM ({_rgb("blue", "stacked", "well, px")}) b""",
    "normalize_images": f"""WITH {STACKED}, {STATS}, {SHARED_STATS}
SELECT well, hwc AS idx, round(f, 5) AS normalised FROM float_pixels""",
    "chunk_sites": f"""WITH {STACKED} SELECT concat(
CASE WHEN site_id % 4 = 0 THEN 'test/HUVEC-' ELSE 'train/RPE-' END,
lpad(CAST(site_id % 3 + 1 AS VARCHAR), 2, '0'), '/Plate', CAST(site_id % 2 + 1 AS VARCHAR),
'/', well, '_s1') AS array_path,
px // 8 // 4 AS cy, px % 8 // 4 AS cx, 4 AS rows, 4 AS cols, 2 * count(*) AS n_bytes,
CAST(sum(val) AS BIGINT) AS total
FROM stacked GROUP BY site_id, well, px // 8 // 4, px % 8 // 4""",
    "pack_images": f"""WITH {RECORDS} SELECT layout, dataset, file, pos, well,
'treatment' AS well_type, experiment, plate, site, split_part(experiment, '-', 1) AS cell_type,
sirna, 8 AS height, 8 AS width, 6 AS channels, CAST(total AS BIGINT) AS total,
CAST(weighted AS BIGINT) AS weighted FROM placed JOIN sums USING (id_code)""",
    "stream_examples": f"""WITH {STACKED}, {STATS}, {SHARED_STATS}
SELECT well, site_id % 1108 AS label, round(sum(f), 4) AS total FROM float_pixels
WHERE site_id % 4 <> 0 GROUP BY well, site_id""",
    "epoch_batches": """WITH copied AS (
SELECT vec_id, CAST(label AS BIGINT) AS label,
row_number() OVER (PARTITION BY vec_id, label) - 1 AS copy, count(*) OVER () AS n FROM embeddings),
epochs AS (SELECT *, md5(concat_ws('|', '42', CAST(epoch AS VARCHAR), CAST(vec_id AS VARCHAR),
CAST(NULLIF(copy, 0) AS VARCHAR))) AS key
FROM copied, (SELECT CAST(unnest([1, 2, 3]) AS INT) AS epoch) e),
placed AS (SELECT *, row_number() OVER (ORDER BY epoch, key, vec_id, label) AS rn FROM epochs)
SELECT vec_id, label, epoch, rn, (rn - 1) // 64 AS batch_id, (rn - 1) % 64 AS batch_pos
FROM placed WHERE (rn - 1) // 64 < n // 64 * 3""",
    "feed_batches": f"""WITH {RECORDS}, {STATS}, {SHARED_STATS},
fed AS (SELECT file, pos, id_code, well, sirna, count(*) OVER () AS n FROM placed
  WHERE layout = 'random-42' AND dataset = 'train'),
epochs AS (SELECT *, row_number() OVER (ORDER BY epoch, md5(concat_ws('|', '42',
  CAST(epoch AS VARCHAR), file, CAST(pos AS VARCHAR))), file, pos) AS rn
  FROM fed, (SELECT CAST(unnest([1, 2]) AS INT) AS epoch) e),
totals AS (SELECT site_id, round(sum(f), 4) AS total FROM float_pixels GROUP BY site_id)
SELECT epoch, (rn - 1) // 8 AS batch_id, (rn - 1) % 8 AS batch_pos, well, sirna AS label, total
FROM epochs JOIN totals ON site_id = id_code WHERE (rn - 1) // 8 < n // 8 * 2""",
    "written_manifest": f"""WITH {RECORDS}
SELECT CASE WHEN layout = 'random-42' THEN 'random' ELSE 'by_exp_plate_site' END AS strategy,
  CAST(42 AS BIGINT) AS seed, dataset,
  CASE WHEN layout = 'random-42' THEN concat('random-42/', dataset, '/', file)
  ELSE concat('by_exp_plate_site-42/', file) END AS dest_path,
  count(*) AS n_sites, min(pos) AS first_pos, max(pos) AS last_pos
FROM placed GROUP BY layout, dataset, file""",
    "score_unlabelled": f"""WITH {STACKED}, {STATS}, {SHARED_STATS}, means AS (
SELECT well, channel, avg(f) AS m FROM float_pixels WHERE site_id % 4 = 0 GROUP BY well, channel)
SELECT well, CAST(arg_max(channel, m) - 1 AS BIGINT) AS class, round(max(m), 3) AS best
FROM means GROUP BY well""",
    "step_plan": """SELECT n_examples, n_classes, n_examples // 64 AS steps_per_epoch,
n_examples // 64 * 3 AS train_steps
FROM (SELECT count(*) AS n_examples, count(DISTINCT label) AS n_classes FROM embeddings) c""",
    "predict_classes": "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 "
                       "AS BIGINT) AS class FROM embeddings",
    "softmax": f"""WITH {LOGITS} SELECT vec_id, CAST(class AS INT) AS class,
round(exp(x - top) / total, 6) AS p
FROM (SELECT vec_id, top, total, unnest(l) AS x, unnest(range(0, len(l))) AS class FROM scored) s""",
    "eval_metrics": f"""WITH {LOGITS} SELECT count(*) AS n,
round(avg(CASE WHEN list_position(l, top) - 1 = label THEN 1.0 ELSE 0.0 END), 6) AS top_1_accuracy,
round(avg(CASE WHEN target IS NOT NULL AND len(list_filter(l, lambda x: x > target)) < 5
THEN 1.0 ELSE 0.0 END), 6) AS top_5_accuracy FROM scored""",
    "row_losses": f"WITH {LOGITS} SELECT vec_id, round({LOSS}, 6) AS loss FROM scored",
    "cross_entropy": f"WITH {LOGITS} SELECT count(*) AS n, round(avg({LOSS}), 6) AS loss "
                     "FROM scored",
    "score_sites": f"""WITH {STACKED}, {STATS}, {SHARED_STATS}, means AS (
SELECT well, channel, avg(f) AS m FROM float_pixels GROUP BY well, channel)
SELECT well, CAST(arg_max(channel, m) - 1 AS BIGINT) AS class, round(max(m), 3) AS best
FROM means GROUP BY well""",
}

ORACLE["load_png_sites"] = f"""WITH {FILED}
SELECT {FILE_KEY}, px * 6 + channel - 1 AS idx, val FROM filled"""
ORACLE["load_png_rgb"] = f"""WITH {FILED}, {COLOURS},
coloured AS (SELECT * REPLACE (pixel AS val) FROM filled)
""" + " UNION ALL ".join(
    f"SELECT {FILE_KEY}, px * 3 + {i} AS idx, v AS val FROM ("
    + _rgb(colour, "coloured", f"{FILE_KEY}, px") + f") c{i}"
    for i, colour in enumerate(("red", "green", "blue")))
ORACLE["scan_png_plates"] = f"""WITH {FILED}
SELECT {FILE_KEY}, channel, 8 AS height, 8 AS width, true AS readable, depth,
CAST(sum(val) AS BIGINT) AS total FROM filed WHERE dataset = 'train'
GROUP BY {FILE_KEY}, channel, depth"""
_ARRAY_PATH = """concat(CASE WHEN site_id % 4 = 0 THEN 'test/HUVEC-' ELSE 'train/RPE-' END,
lpad(CAST(site_id % 3 + 1 AS VARCHAR), 2, '0'), '/Plate', CAST(site_id % 2 + 1 AS VARCHAR),
'/', well, '_s1')"""
ORACLE["assemble_arrays"] = f"""WITH {STACKED} SELECT {_ARRAY_PATH} AS array_path,
8 AS height, 8 AS width, hwc AS idx, val FROM stacked"""
ORACLE["read_window"] = f"""WITH {STACKED} SELECT {_ARRAY_PATH} AS array_path,
5 AS height, 4 AS width, ((px // 8 - 2) * 4 + px % 8 - 4) * 6 + channel - 1 AS idx, val
FROM stacked WHERE px // 8 BETWEEN 2 AND 6 AND px % 8 >= 4"""
ORACLE["read_experiments"] = f"""WITH {RECORDS}
SELECT layout, dataset, file, pos, experiment, well, CAST(total AS BIGINT) AS total
FROM placed JOIN sums USING (id_code) WHERE experiment = 'RPE-02'"""
ORACLE["stream_planes"] = f"""WITH {FILED}
SELECT {FILE_KEY}, channel, 8 AS height, 8 AS width, true AS readable,
CAST(sum(pixel) AS BIGINT) AS total FROM filed GROUP BY {FILE_KEY}, channel"""
ORACLE["pixel_percentiles"] = f"""WITH {PIXELS}, levels AS (
SELECT concat(CASE WHEN site_id % 4 = 0 THEN 'HUVEC-' ELSE 'RPE-' END,
  lpad(CAST(site_id % 3 + 1 AS VARCHAR), 2, '0')) AS experiment, channel, val, count(*) AS n
FROM pixels GROUP BY ALL),
running AS (SELECT *, sum(n) OVER (PARTITION BY experiment, channel ORDER BY val) AS upto,
  sum(n) OVER (PARTITION BY experiment, channel) AS total FROM levels)
SELECT experiment, channel, CAST(any_value(total) AS BIGINT) AS n,
round(sum(val * n) / CAST(sum(n) AS DOUBLE), 6) AS mean,
round(sqrt(sum(val * val * n) / CAST(sum(n) AS DOUBLE)
  - (sum(val * n) / CAST(sum(n) AS DOUBLE)) * (sum(val * n) / CAST(sum(n) AS DOUBLE))), 6) AS std,
CAST(min(val) FILTER (upto * 100 >= total) AS INTEGER) AS p1,
CAST(min(val) FILTER (upto * 100 >= total * 50) AS INTEGER) AS p50,
CAST(min(val) FILTER (upto * 100 >= total * 99) AS INTEGER) AS p99
FROM running GROUP BY experiment, channel"""
ORACLE["pack_bucketed"] = ORACLE["pack_images"]
ORACLE["strict_sites"] = ORACLE["load_sites"]
ORACLE["write_arrays"] = ORACLE["chunk_sites"]
ORACLE["convert_sites"] = ORACLE["chunk_sites"]
ORACLE["metadata_csv"] = f"""WITH {SITES} SELECT CAST(id_code AS VARCHAR) AS id_code, dataset,
experiment, cell_type, plate, well, well_type, sirna, site FROM sites"""
ORACLE["file_summaries"] = f"""WITH {RECORDS} SELECT layout, dataset, file, count(*) AS n,
CAST(sum(total) AS BIGINT) AS total FROM placed JOIN sums USING (id_code)
WHERE layout = 'random-42' GROUP BY layout, dataset, file"""

_STATS_SQL = f"""WITH {PIXELS}, sums AS (SELECT channel, count(*) AS n, sum(val) AS t,
sum(val * val) AS s FROM pixels GROUP BY channel)
SELECT channel, n, round(t / CAST(n AS DOUBLE), 6) AS mean,
round(sqrt(s / CAST(n AS DOUBLE) - (t / CAST(n AS DOUBLE)) * (t / CAST(n AS DOUBLE))), 6) AS std
FROM sums"""
ORACLE["pixel_stats"] = _STATS_SQL
ORACLE["pixel_stats_images"] = _STATS_SQL
