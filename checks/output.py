"""Export rows, files, batches, statistics and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.answers import BATCH_DUCK, OPTIONS_DUCK
from checks.grouping import members
from checks.parsing import IN_ORDER_COLUMNS, MARKED_DUCK, PROD_COLUMNS, Query, cat, images_as_text, in_order, price_list_files, slug_sql
from checks.views import VIEWS, duck, keys_of, products, view
from wareflow.functions.options import normal_option_name
from wareflow.functions.text import number_text
from wareflow.operators import batches as b
from wareflow.operators import export as x
from wareflow.operators import validation as v
from wareflow.operators.grouping import group_images, group_index, leader_groups
from wareflow.operators.handles import unique_handles
from wareflow.operators.layouts import IMPORT_COLUMNS, METAFIELDS
from wareflow.operators.ordering import global_row_index
from wareflow.operators.requests import apply_batch
from wareflow.operators.shared import compiled_methods, shared_folder, stored
from wareflow.operators.stats import run_stats
from wareflow.plans.catalogue import KEPT, catalogue_files, catalogue_import, counted_run, groups_of, import_columns, resumed_import
from wareflow.sources.import_files import read_import_file, write_import_csv, write_import_files
from wareflow.sources.tables import read_batches, write_batches
from wareflow.streaming.ingest import incremental_ingest, ingest_batch, ingested_products, raw_tables, rerun_failed


def opts(s, d):
    """Variants with an option list each."""
    pair = lambda name, value: F.struct(F.col(name).alias("name"), value.alias("value"))
    blank = F.when(F.col("row_no") % 4 == 1, F.lit("")).otherwise(F.col("w2"))
    return view(s, d, "opts").select(
        "row_no", "group_no", "brand", "base_name", "upc", "name", "price", "images",
        F.array(pair("n1", F.col("w1")), pair("n2", blank), pair("n3", F.col("w2"))).alias("options"),
    )


_FLAT_OPTS = """flat AS (
  SELECT row_no, group_no, unnest([1, 2, 3]) AS pos, trim(unnest([n1, n2, n3])) AS raw,
    unnest([w1, CASE WHEN row_no % 4 = 1 THEN '' ELSE w2 END, w2]) AS value FROM opts),
named AS (SELECT *, CASE WHEN regexp_matches(lower(raw), 'flavor|scent|fragrance') THEN 'Flavor' WHEN regexp_matches(lower(raw), 'size|volume|weight') THEN 'Size'
    WHEN regexp_matches(lower(raw), 'color|colour|shade') THEN 'Color' WHEN regexp_matches(lower(raw), 'type|formula|finish') THEN 'Type'
    WHEN regexp_matches(lower(raw), 'material|fabric') THEN 'Material' WHEN regexp_matches(lower(raw), 'style|design') THEN 'Style'
    WHEN split_part(raw, '/', 1) = '' THEN NULL
    ELSE upper(left(split_part(raw, '/', 1), 1)) || lower(substr(split_part(raw, '/', 1), 2)) END AS nm FROM flat),
"""
_STANDARD = """used AS (SELECT group_no, nm, count(DISTINCT row_no) AS c FROM named WHERE nm IS NOT NULL GROUP BY ALL),
sizes AS (SELECT group_no, count(*) AS n FROM {rows} GROUP BY group_no),
std AS (SELECT s.group_no, coalesce(list(nm ORDER BY nm) FILTER (c >= greatest(1.0, n * 0.3)), []) AS names FROM sizes s LEFT JOIN used u USING (group_no) GROUP BY s.group_no)"""
STANDARD_DUCK = f"WITH {_FLAT_OPTS} {_STANDARD.format(rows='opts')}"
_VALUES = ", ".join(
    f"""coalesce(CASE WHEN len(names) >= {i} THEN (SELECT arg_max(value, pos) FROM named m WHERE m.row_no = o.row_no AND m.nm = names[{i}] AND value <> '') END, '') AS value{i}"""
    for i in (1, 2, 3)
)

HANDLES_DUCK = """
SELECT group_no, handle FROM (
  SELECT *, CASE WHEN nth = 1 THEN base WHEN nth4 = 1 THEN base || '-' || right(upc, 4) ELSE base || '-' || upc END AS handle FROM (
    SELECT *, row_number() OVER (PARTITION BY base, right(upc, 4), nth > 1 ORDER BY gi) AS nth4 FROM (
      SELECT *, row_number() OVER (PARTITION BY base ORDER BY gi) AS nth FROM {named_groups})))
"""

# the whole conversion: groups by similarity, enriched, exported
FULL_DUCK = f"""WITH enriched AS (
  SELECT g.group_no, g.brand, g.upc, g.gi, b.answered, b.cleaned_name AS title, b.category, b.tags, b.description, b.benefits, b.ingredients, b.good_for, b.suggested_usage, b.allergy_info
  FROM grp g JOIN (SELECT DISTINCT * EXCLUDE (row_no) FROM ({BATCH_DUCK.replace('FROM keys k', 'FROM gkeys k')})) b
    ON b.brand = g.brand AND b.name = g.base_name AND b.price IS NOT DISTINCT FROM g.price),
handles AS ({HANDLES_DUCK.format(named_groups=f"(SELECT group_no, gi, upc, {slug_sql('brand || chr(45) || title')} AS base FROM enriched)")}),
vopts AS ({OPTIONS_DUCK}),
lines AS (
  SELECT m.*, coalesce(o.options, []) AS options, CAST(sum(len(images)) OVER w - len(images) AS BIGINT) AS before, CAST(sum(greatest(len(images), 1)) OVER w - greatest(len(images), 1) AS BIGINT) AS rows_before
  FROM members m LEFT JOIN vopts o ON o.cache_key = 'variants|' || m.name WINDOW w AS (PARTITION BY group_no ORDER BY row_no)),
flat AS (SELECT row_no, group_no, unnest(options).value AS value, trim(unnest(options).name) AS raw, generate_subscripts(options, 1) AS pos FROM lines),
{_FLAT_OPTS[_FLAT_OPTS.index('named AS'):]}
{_STANDARD.format(rows='members')},
last_values AS (SELECT row_no, nm, arg_max(trim(value), pos) AS value FROM named WHERE trim(value) <> '' GROUP BY ALL),
out AS (
  SELECT l.*, s.names, h.handle, e.*  EXCLUDE (group_no, brand, upc, category), e.category AS cat_text, i,
    CASE WHEN len(images) > 0 THEN images[i] END AS src,
    v1.value AS value1, v2.value AS value2, v3.value AS value3
  FROM (SELECT *, unnest(range(1, CAST(greatest(len(images), 1) AS INTEGER) + 1)) AS i FROM lines) l
  JOIN std s USING (group_no) JOIN handles h USING (group_no) JOIN enriched e USING (group_no)
  LEFT JOIN last_values v1 ON v1.row_no = l.row_no AND v1.nm = s.names[1]
  LEFT JOIN last_values v2 ON v2.row_no = l.row_no AND v2.nm = s.names[2]
  LEFT JOIN last_values v3 ON v3.row_no = l.row_no AND v3.nm = s.names[3])
"""


def _on(cond: str, expr: str) -> str:
    return f"CASE WHEN {cond} THEN {expr} ELSE '' END"


_FIRST, _PRIMARY = "i = 1", "row_no = group_no"
_IMPORT = {
    "Handle": "handle", "Title": _on(_PRIMARY, "title"), "Body (HTML)": _on(_PRIMARY, "description"), "Vendor": "brand",
    "Type": "CASE WHEN contains(cat_text, '>') THEN trim(string_split(cat_text, '>')[-1]) ELSE cat_text END",
    "Tags": _on(_PRIMARY, "replace(tags, '|', ',')"), "Published": _on(_PRIMARY, "'TRUE'"), "Status": _on(_PRIMARY, "'active'"),
    **{f"Option{k} Name": f"coalesce(names[{k}], '')" for k in (1, 2, 3)},
    **{f"Option{k} Value": f"coalesce(value{k}, '')" for k in (1, 2, 3)},
    "Variant SKU": _on(_FIRST, "upc"), "Variant Barcode": _on(_FIRST, "upc"), "Variant Inventory Tracker": _on(_FIRST, "'shopify'"),
    "Variant Inventory Policy": _on(_FIRST, "'continue'"), "Variant Fulfillment Service": _on(_FIRST, "'manual'"),
    "Variant Price": "price", "Variant Requires Shipping": "'TRUE'", "Variant Taxable": "'TRUE'", "Image Src": "coalesce(src, '')",
    "Image Position": "CASE WHEN src IS NOT NULL THEN before + i END", "Image Alt Text": _on("src IS NOT NULL", "brand || ' ' || name"), "Gift Card": "'FALSE'",
    **{column: _on(_PRIMARY, field) for column, field in METAFIELDS.items()},
}
IMPORT_SELECT = ", ".join(f"""{_IMPORT.get(n, "''")} AS "{n}\"""" for n in IMPORT_COLUMNS)

# groups of the full conversion, with the columns the answers are looked up by
VIEWS.setdefault(
    "grp",
    (
        lambda s, d: groups_of(members(s, d)),
        """SELECT *, row_number() OVER (ORDER BY first_in_brand, group_no) AS gi FROM (
           SELECT group_no, brand, base_name, count(*) AS n, arg_min(upc, row_no) AS upc, any_value(price) FILTER (row_no = group_no) AS price,
             min(group_no) OVER (PARTITION BY brand) AS first_in_brand FROM {members} GROUP BY group_no, brand, base_name)""",
    ),
)
VIEWS.setdefault(
    "gkeys",
    (
        lambda s, d: view(s, d, "grp").select(
            F.col("group_no").alias("row_no"), "brand", F.col("base_name").alias("name"), "price",
            number_text(F.col("price")).alias("price_text"),
        ),
        "SELECT group_no AS row_no, brand, base_name AS name, price, CAST(price AS VARCHAR) AS price_text FROM {grp}",
    ),
)
VIEWS.setdefault(
    "gresp",
    (
        lambda s, d: s.sql(VIEWS["resp"].replace("{keys}", "{allkeys}"), allkeys=_all_keys(s, d)),
        VIEWS["resp"].replace("{keys}", "(SELECT row_no, brand, name, price_text FROM {gkeys} UNION ALL SELECT row_no + 1000000000, brand, name, price_text FROM {keys})"),
    ),
)


def _all_keys(s, d, group_keys=None, keys=None):
    columns = ["row_no", "brand", "name", "price_text"]
    group_keys = view(s, d, "gkeys") if group_keys is None else group_keys
    return group_keys.select(columns).unionByName(
        (view(s, d, "keys") if keys is None else keys).withColumn("row_no", F.col("row_no") + 1000000000).select(columns)
    )


def _conversion(s, d):
    """(members, answers) of the full conversion; the catalogue is parsed once, the members are written once."""
    folder = shared_folder(s)
    with compiled_methods(s):
        parsed = stored(products(s, d), folder, "parsed")
        rows = stored(leader_groups(parsed, written=True), folder, "members")
        group_keys = groups_of(rows).select(
            F.col("group_no").alias("row_no"), "brand", F.col("base_name").alias("name"), number_text(F.col("price")).alias("price_text")
        )
        # the answers ask for the keys twice
        group_keys = stored(group_keys, folder, "group-keys")
        answers = s.sql(VIEWS["resp"].replace("{keys}", "{allkeys}"), allkeys=_all_keys(s, d, group_keys, keys_of(parsed)))
        return rows, stored(answers, folder, "answers")


_KEPT = ("group_no", "group_index", "batch_no", "line_no")


def import_rows(s, d, keep=(), **options):
    rows, answers = _conversion(s, d)
    return catalogue_import(rows, answers, keep=keep, **options)


def _resumed_import(s, d):
    """A run that is stopped after two batches of 20 groups, then one that goes on to the end."""
    path = f"{shared_folder(s)}/batches"
    rows, answers = _conversion(s, d)
    resumed_import(rows, answers, path, groups_per_batch=20, max_batches=2)
    return import_columns(resumed_import(rows, answers, path, groups_per_batch=20))


def _resumed_after_change(s, d):
    """A finished run with other batches and without some answers, then one with all that there is."""
    path = f"{shared_folder(s)}/batches"
    rows, answers = _conversion(s, d)
    resumed_import(rows, answers.where(F.length("cache_key") % 7 != 0), path, groups_per_batch=30)
    return import_columns(resumed_import(rows, answers, path, groups_per_batch=20))


def _limited_files(s, d):
    """Two batches of many: the file names still count all batches."""
    rows = catalogue_files(import_rows(s, d, KEPT, groups_per_batch=20, max_batches=2), 40)
    return rows.select("group_index", "line_no", "batch_no", "batch_row", "file_no", "file_name")


def _deliver(raw, folder, test) -> None:
    """Some raw rows as Parquet files."""
    raw.where(test).repartitionByRange(2, "row_no").write.mode("append").parquet(f"{folder}/incoming")


def _halves(raw):
    half = raw.select(F.expr("percentile_approx(row_no, 0.5)")).scalar()
    return F.col("row_no") <= half, F.col("row_no") > half


def _ingest(s, raw, folder, **options) -> None:
    incremental_ingest(s, f"{folder}/incoming", f"{folder}/target", f"{folder}/progress", raw_tables(raw.schema), files="part-*", **options).awaitTermination()


def _ingested(s, folder):
    return images_as_text(ingested_products(s, f"{folder}/target"))


def _ingest_after_failure(s, d):
    """Two deliveries; the first breaks after its products are written, and is run again at the end."""
    folder, raw = shared_folder(s), cat(s, d)

    def breaks(rows, target, batch_id):
        if batch_id:
            return ingest_batch(rows, target, batch_id)
        rows.select("upc").withColumn("batch_id", F.lit(0)).write.partitionBy("batch_id").parquet(f"{target}/codes")
        raise OSError("disk full")

    for test in reversed(_halves(raw)):
        _deliver(raw, folder, test)
        _ingest(s, raw, folder, process=breaks)
    rerun_failed(s, f"{folder}/target", raw_tables(raw.schema))
    return _ingested(s, folder)


def _ingest_past_broken_file(s, d):
    """Three deliveries; the files of the second are no tables, and stay so when it is run again."""
    folder, raw = shared_folder(s), cat(s, d)
    first, second = _halves(raw)
    _deliver(raw, folder, first)
    _ingest(s, raw, folder)
    raw.select(F.coalesce("name", F.lit(""))).write.text(f"{folder}/incoming/broken")
    _ingest(s, raw, folder)
    _deliver(raw, folder, second)
    _ingest(s, raw, folder)
    still = rerun_failed(s, f"{folder}/target", raw_tables(raw.schema))
    return _ingested(s, folder).withColumn("failed_deliveries", F.lit(len(still)))


def _ingest_price_lists(s, d):
    """CSV price lists of different layouts and encodings, two files a delivery; rows keep their order."""
    folder = shared_folder(s)
    price_list_files(s, d, folder=f"{folder}/incoming")
    incremental_ingest(s, f"{folder}/incoming", f"{folder}/target", f"{folder}/progress", max_files=2, files="part-*").awaitTermination()
    return in_order(_ingested(s, folder))


def _full(select: str) -> str:
    text = FULL_DUCK.replace("FROM resp", "FROM gresp")
    return duck(f"{text} {select}", "members", "grp", "gkeys", "gresp")


def imp(s, d):
    return view(s, d, "imp")


def _write_read(s, d):
    path = f"{shared_folder(s)}/import"
    write_import_csv(imp(s, d).drop("row_no"), path)
    return read_import_file(s, path).drop("row_no")


def _write_read_files(s, d):
    """Import rows written as one file per batch part, and all their cells read back with the name of their file."""
    path = f"{shared_folder(s)}/files"
    rows = catalogue_files(import_rows(s, d, _KEPT))
    write_import_files(rows.drop("group_no"), path, ["group_index", "line_no"])
    names = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file_name")
    back = s.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    numbers = {"Variant Price": "double", "Image Position": "bigint"}
    cells = [F.col(f"`{c}`").cast(numbers[c]).alias(c) if c in numbers else F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in IMPORT_COLUMNS]
    return back.select(names, *cells)


def _resume(s, d):
    """Half of the batches are done and stored; the others are left to do."""
    path = f"{shared_folder(s)}/batches"
    rows = b.assign_batches(group_index(members(s, d).select("group_no", "brand").distinct()), 20)
    rows = stored(rows, shared_folder(s), "rows")
    write_batches(rows.where("batch_no % 2 = 0"), path)
    return b.pending_batches(rows, read_batches(s, path)).select("group_no", "batch_no")


def ingest_twice(s, raw):
    """A catalogue delivered as two sets of files, one after the other."""
    folder = shared_folder(s)
    for test in _halves(raw):
        _deliver(raw, folder, test)
        _ingest(s, raw, folder, max_files=10)
    return _ingested(s, folder)


def _run_stats(s, d):
    rows, answers = _conversion(s, d)
    groups = apply_batch(groups_of(rows), answers)
    files = catalogue_files(catalogue_import(rows, answers, keep=_KEPT))
    return run_stats(cat(s, d), rows, groups, group_images(rows), files)


def _limits(s, d):
    return view(s, d, "part").select(
        F.col("p_partkey").alias("product_no"),
        F.repeat(F.col("p_name"), F.when(F.col("p_partkey") % 17 == 0, 40).otherwise(1)).alias("handle"),
        F.repeat(F.col("p_name"), F.when(F.col("p_partkey") % 19 == 0, 40).otherwise(1)).alias("title"),
        F.repeat(F.col("p_name"), F.when(F.col("p_partkey") % 23 == 0, 600).otherwise(1)).alias("description"),
        F.split(
            F.concat(
                F.when(F.col("p_partkey") % 37 == 0, F.concat(F.repeat("p_type", 4), F.lit(","))).otherwise(F.lit("")),
                F.repeat(F.concat("p_type", F.lit(",")), (F.col("p_partkey") % 13).cast("int")),
            ),
            ",",
        ).alias("tags"),
        (F.when(F.col("p_partkey") % 29 == 0, -1.0).when(F.col("p_partkey") % 31 == 0, 2000.0).otherwise(1.0) * F.col("p_retailprice")).alias("price"),
        (F.col("p_partkey") % 5).alias("n_images"),
    )


_LIMITS_DUCK = """WITH r AS (SELECT p_partkey AS product_no,
  length(p_name) * CASE WHEN p_partkey % 17 = 0 THEN 40 ELSE 1 END AS h, length(p_name) * CASE WHEN p_partkey % 19 = 0 THEN 40 ELSE 1 END AS t,
  length(p_name) * CASE WHEN p_partkey % 23 = 0 THEN 600 ELSE 1 END AS d, p_partkey % 13 + 1 + CASE WHEN p_partkey % 37 = 0 THEN 1 ELSE 0 END AS n, p_partkey % 37 = 0 AND length(p_type) * 4 > 50 AS long_tag,
  CASE WHEN p_partkey % 29 = 0 THEN -1.0 WHEN p_partkey % 31 = 0 THEN 2000.0 ELSE 1.0 END * p_retailprice AS price, p_partkey % 5 AS k FROM part)
SELECT product_no, rule FROM (SELECT product_no, unnest([
  CASE WHEN h > 255 THEN 'handle_max_length' END, CASE WHEN t > 255 THEN 'title_max_length' END, CASE WHEN d > 5000 THEN 'description_max_length' END,
  CASE WHEN long_tag THEN 'tag_max_length' END, CASE WHEN n < 6 THEN 'tag_min_count' END, CASE WHEN n > 10 THEN 'tag_max_count' END, CASE WHEN price < 0 THEN 'price_min' END,
  CASE WHEN price > 999999 THEN 'price_max' END, CASE WHEN k > 3 THEN 'max_images_per_product' END]) AS rule FROM r) WHERE rule IS NOT NULL"""

CATEGORY_V = """SELECT 'category_format' AS rule, 'error' AS severity, CAST(NULL AS VARCHAR) AS handle, CAST(NULL AS BIGINT) AS row_no, c AS detail
  FROM (SELECT DISTINCT "Product Category" AS c FROM imp) WHERE c <> '' AND NOT contains(c, '>')
  UNION ALL SELECT 'category_format', 'warning', NULL, NULL, 'no product categories' FROM imp HAVING count(*) FILTER ("Product Category" <> '') = 0"""
OPTION_NAMES_V = """SELECT 'option_names' AS rule, 'error' AS severity, h AS handle, CAST(NULL AS BIGINT) AS row_no,
  concat_ws(',', CASE WHEN n1 > 1 THEN 'Option1' END, CASE WHEN n2 > 1 THEN 'Option2' END, CASE WHEN n3 > 1 THEN 'Option3' END) AS detail
  FROM (SELECT "Handle" AS h, count(DISTINCT nullif("Option1 Name", '')) AS n1, count(DISTINCT nullif("Option2 Name", '')) AS n2, count(DISTINCT nullif("Option3 Name", '')) AS n3 FROM imp GROUP BY 1)
  WHERE greatest(n1, n2, n3) > 1"""
OPTION_PAIRS_V = " UNION ALL ".join(
    f"""SELECT 'option_pairs' AS rule, 'error' AS severity, "Handle" AS handle, row_no, 'Option{i}' AS detail FROM imp WHERE "Option{i} Name" = '' AND "Option{i} Value" <> ''"""
    for i in (1, 2, 3)
)
REQUIRED_V = """SELECT 'required' AS rule, 'error' AS severity, "Handle" AS handle, row_no, m AS detail FROM (
  SELECT *, concat_ws(', ', CASE WHEN "Handle" = '' THEN 'Handle' END, CASE WHEN "Title" = '' THEN 'Title' END, CASE WHEN "Vendor" = '' THEN 'Vendor' END, CASE WHEN "Variant Price" = '' THEN 'Variant Price' END) AS m FROM imp) WHERE m <> ''"""
ALL_V = " UNION ALL ".join(f"({q})" for q in (CATEGORY_V, OPTION_NAMES_V, OPTION_PAIRS_V, REQUIRED_V))


def _brief(col: str, n: int) -> str:
    return f"""CASE WHEN "{col}" = '' THEN 'EMPTY' ELSE left("{col}", {n}) || '...' END"""


_LINES = _full(
    """SELECT e.gi AS group_index, l.group_no, CAST(floor((e.gi - 1) / 100) AS BIGINT) + 1 AS batch_no, l.rows_before + u.i AS line_no
    FROM lines l JOIN enriched e USING (group_no), LATERAL (SELECT unnest(range(1, CAST(greatest(len(l.images), 1) AS INTEGER) + 1)) AS i) u"""
)
_FILES_DUCK = f"""WITH lines_out AS ({_LINES}),
placed AS (SELECT *, row_number() OVER (PARTITION BY batch_no ORDER BY group_index, line_no) AS batch_row, count(*) OVER (PARTITION BY batch_no) AS n, max(batch_no) OVER () AS nb FROM lines_out)
"""
_FILE_NAME = """'products' || CASE WHEN nb = 1 AND n <= {m} THEN '' ELSE '_batch' || lpad(CAST(batch_no AS VARCHAR), 3, '0') END
  || CASE WHEN n > {m} THEN '_part' || lpad(CAST(CAST(floor((batch_row - 1) / {m}) AS INTEGER) + 1 AS VARCHAR), 3, '0') ELSE '' END || '.csv'"""


def _split(s, d, max_rows):
    rows = catalogue_files(import_rows(s, d, _KEPT), max_rows)
    return rows.select("group_index", "line_no", "batch_no", "batch_row", "file_no", "file_name")


_RUN_STATS_DUCK = f""", parsed AS ({MARKED_DUCK}), nfiles AS (SELECT b, ceil(count(*) / 1000) AS f FROM (SELECT (gi - 1) // 100 AS b FROM out) GROUP BY b),
            imgs AS (SELECT count(DISTINCT (group_no, src)) AS n FROM out WHERE src IS NOT NULL)
            SELECT count(*) AS total_rows_read, count(*) FILTER (code IS NOT NULL AND nth = 1 AND nm IS NOT NULL) AS valid_products,
              count(*) FILTER (code IS NOT NULL AND nth > 1) AS skipped_duplicates, count(*) FILTER (code IS NULL OR (nth = 1 AND nm IS NULL)) AS skipped_incomplete,
              CAST(0 AS BIGINT) AS parsing_errors, (SELECT count(*) FROM grp) AS total_product_groups, (SELECT count(*) FROM members) AS total_variants,
              (SELECT count(*) FROM enriched WHERE answered) AS successfully_processed, (SELECT count(*) FROM enriched WHERE NOT answered) AS failed_enrichment,
              (SELECT n FROM imgs) AS total_images, (SELECT count(*) FROM out) AS csv_rows_generated, (SELECT CAST(sum(f) AS BIGINT) FROM nfiles) AS output_files_generated FROM parsed"""


QUERIES: dict[str, Query] = {
    "normal_option_name": (
        lambda s, d: opts(s, d).select("row_no", F.posexplode("options").alias("p", "o")).select(
            "row_no", (F.col("p") + 1).alias("pos"), normal_option_name(F.col("o.name")).alias("name")
        ),
        duck(f"WITH {_FLAT_OPTS.rstrip().rstrip(',')} SELECT row_no, pos, nm AS name FROM named", "opts"),
    ),
    "standard_options": (
        lambda s, d: x.standard_options(opts(s, d)),
        duck(
            f"{STANDARD_DUCK} SELECT group_no, coalesce(names[1], '') AS option1, coalesce(names[2], '') AS option2, coalesce(names[3], '') AS option3 FROM std",
            "opts",
        ),
    ),
    "option_values": (
        lambda s, d: x.option_values(opts(s, d)).select("row_no", *[f"option{i}" for i in (1, 2, 3)], *[f"value{i}" for i in (1, 2, 3)]),
        duck(
            f"{STANDARD_DUCK} SELECT o.row_no, coalesce(names[1], '') AS option1, coalesce(names[2], '') AS option2, coalesce(names[3], '') AS option3, {_VALUES} FROM opts o JOIN std USING (group_no)",
            "opts",
        ),
    ),
    "unique_handles": (
        lambda s, d: unique_handles(groups_of(members(s, d))),
        duck(
            "WITH x AS (SELECT 1) " + HANDLES_DUCK.format(named_groups=f"(SELECT group_no, gi, upc, {slug_sql('brand || chr(45) || base_name')} AS base FROM grp)"),
            "grp",
        ),
    ),
    "variant_image_rows": (
        lambda s, d: x.variant_image_rows(view(s, d, "groups").select("row_no", "group_no", "images")).drop("images"),
        duck(
            """WITH l AS (SELECT *, CAST(sum(len(images)) OVER w - len(images) AS BIGINT) AS before, CAST(sum(greatest(len(images), 1)) OVER w - greatest(len(images), 1) AS BIGINT) AS rb
              FROM groups WINDOW w AS (PARTITION BY group_no ORDER BY row_no)),
            u AS (SELECT *, unnest(range(1, CAST(greatest(len(images), 1) AS INTEGER) + 1)) AS i FROM l)
            SELECT row_no, group_no, images[i] AS image_src, CASE WHEN len(images) > 0 THEN before + i END AS image_position, i = 1 AS first_row, rb + i AS line_no FROM u""",
            "groups",
        ),
    ),
    "import_projection": (
        lambda s, d: import_columns(import_rows(s, d)),
        _full(f"SELECT {IMPORT_SELECT} FROM out"),
    ),
    "column_order": (
        lambda s, d: x.column_order(imp(s, d)),
        duck(
            "SELECT " + ", ".join(
                f'"{c}"' if f"`{c}`" in VIEWS["imp"] else f"""'' AS "{c}\"""" for c in IMPORT_COLUMNS
            ) + " FROM imp",
            "imp",
        ),
    ),
    "global_row_index": (
        lambda s, d: images_as_text(global_row_index(products(s, d), "row_no", chunk=256)),
        duck(f"SELECT {PROD_COLUMNS}, row_number() OVER (ORDER BY row_no) AS row_index FROM prod", "prod"),
    ),
    "assign_batches": (
        lambda s, d: b.assign_batches(groups_of(members(s, d)), 20).select("group_no", "batch_no"),
        duck("SELECT group_no, CAST(floor((gi - 1) / 20) AS BIGINT) + 1 AS batch_no FROM grp", "grp"),
    ),
    "limit_batches": (
        lambda s, d: b.limit_batches(b.assign_batches(groups_of(members(s, d)), 20), 3).select("group_no", "batch_no"),
        duck("SELECT group_no, CAST(floor((gi - 1) / 20) AS BIGINT) + 1 AS batch_no FROM grp WHERE gi <= 60", "grp"),
    ),
    "split_files": (lambda s, d: _split(s, d, 120), duck(
        _FILES_DUCK + f"SELECT group_index, line_no, batch_no, batch_row, CAST(floor((batch_row - 1) / 120) AS BIGINT) + 1 AS file_no, {_FILE_NAME.format(m=120)} AS file_name FROM placed"
    )),
    "split_catalogue": (
        lambda s, d: images_as_text(b.split_catalogue(products(s, d), "row_no", 500)),
        duck(
            f"""SELECT {PROD_COLUMNS}, r AS file_row, CAST(floor((r - 1) / 500) AS BIGINT) + 1 AS file_no,
            'products' || CASE WHEN n > 500 THEN '_part' || lpad(CAST(CAST(floor((r - 1) / 500) AS BIGINT) + 1 AS VARCHAR), 3, '0') ELSE '' END || '.csv' AS file_name
            FROM (SELECT *, row_number() OVER (ORDER BY row_no) AS r, count(*) OVER () AS n FROM prod)""",
            "prod",
        ),
    ),
    "file_plan": (
        lambda s, d: b.file_plan(view(s, d, "lineitem").agg(F.count("*").alias("total_rows"))),
        """WITH t AS (SELECT count(*) AS n FROM lineitem), f AS (SELECT n, unnest(range(1, CAST(ceil(n / 1000) AS BIGINT) + 1)) AS file_no FROM t)
        SELECT file_no, (file_no - 1) * 1000 + 1 AS first_row, least(file_no * 1000, n) AS last_row, least(file_no * 1000, n) - (file_no - 1) * 1000 AS n_rows FROM f""",
    ),
    "write_read_import": (
        _write_read,
        duck("SELECT * EXCLUDE (row_no) FROM imp", "imp"),
    ),
    "write_read_files": (
        _write_read_files,
        _full(
            f"""SELECT {_FILE_NAME.format(m=1000)} AS file_name, {IMPORT_SELECT} FROM (
            SELECT *, CAST(floor((gi - 1) / 100) AS BIGINT) + 1 AS batch_no, row_number() OVER (PARTITION BY CAST(floor((gi - 1) / 100) AS BIGINT) ORDER BY gi, rows_before + i) AS batch_row,
              count(*) OVER (PARTITION BY CAST(floor((gi - 1) / 100) AS BIGINT)) AS n, (max(gi) OVER () - 1) // 100 + 1 AS nb FROM out)"""
        ),
    ),
    "resume_batches": (
        _resume,
        duck("SELECT group_no, CAST(floor((gi - 1) / 20) AS BIGINT) + 1 AS batch_no FROM grp WHERE (CAST(floor((gi - 1) / 20) AS BIGINT) + 1) % 2 = 1", "grp"),
    ),
    "ingest_past_broken_file": (
        _ingest_past_broken_file,
        duck(f"SELECT {PROD_COLUMNS}, 1 AS failed_deliveries FROM prod", "prod"),
    ),
    "ingest_price_lists": (
        _ingest_price_lists,
        duck(f"SELECT {IN_ORDER_COLUMNS} FROM fprod", "fprod"),
    ),
    "incremental_ingest": (
        lambda s, d: ingest_twice(s, cat(s, d)),
        duck(f"SELECT {PROD_COLUMNS} FROM prod", "prod"),
    ),
    "ingest_after_failure": (
        # the later rows fail first and are run again last, so the earlier rows take their codes as ever
        _ingest_after_failure,
        duck(f"SELECT {PROD_COLUMNS} FROM prod", "prod"),
    ),
    "limited_files": (
        _limited_files,
        _full(
            f"""SELECT group_index, line_no, batch_no, batch_row, CAST(floor((batch_row - 1) / 40) AS BIGINT) + 1 AS file_no, {_FILE_NAME.format(m=40)} AS file_name
            FROM (SELECT *, row_number() OVER (PARTITION BY batch_no ORDER BY group_index, line_no) AS batch_row, count(*) OVER (PARTITION BY batch_no) AS n, max(batch_no) OVER () AS nb
              FROM (SELECT e.gi AS group_index, l.rows_before + u.i AS line_no, CAST(floor((e.gi - 1) / 20) AS BIGINT) + 1 AS batch_no
                FROM lines l JOIN enriched e USING (group_no), LATERAL (SELECT unnest(range(1, CAST(greatest(len(l.images), 1) AS INTEGER) + 1)) AS i) u)) WHERE batch_no <= 2"""
        ),
    ),
    "resume_import": (
        _resumed_import,
        _full(f"SELECT {IMPORT_SELECT} FROM out"),
    ),
    "resume_after_change": (
        _resumed_after_change,
        _full(f"SELECT {IMPORT_SELECT} FROM out"),
    ),
    "run_stats": (
        _run_stats,
        _full(_RUN_STATS_DUCK),
    ),
    "counted_run": (
        lambda s, d: counted_run(cat(s, d), _conversion(s, d)[1], f"{shared_folder(s)}/run"),
        _full(_RUN_STATS_DUCK),
    ),
    "check_category_format": (lambda s, d: v.check_category_format(imp(s, d)), duck(CATEGORY_V, "imp")),
    "check_category_missing": (
        lambda s, d: v.check_category_format(imp(s, d).withColumn("Product Category", F.lit(""))),
        "SELECT 'category_format' AS rule, 'warning' AS severity, CAST(NULL AS VARCHAR) AS handle, CAST(NULL AS BIGINT) AS row_no, 'no product categories' AS detail FROM part HAVING count(*) > 0",
    ),
    "check_option_names": (lambda s, d: v.check_option_names(imp(s, d)), duck(OPTION_NAMES_V, "imp")),
    "check_option_pairs": (lambda s, d: v.check_option_pairs(imp(s, d)), duck(OPTION_PAIRS_V, "imp")),
    "check_required": (lambda s, d: v.check_required(imp(s, d)), duck(REQUIRED_V, "imp")),
    "validation_report": (
        lambda s, d: v.validation_report(imp(s, d)),
        duck(
            f"""WITH f AS ({ALL_V}) SELECT (SELECT count(DISTINCT "Handle") FROM imp) AS products, (SELECT count(*) FROM imp) AS rows,
            count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings, count(*) FILTER (severity = 'error') = 0 AS passed FROM f""",
            "imp",
        ),
    ),
    "check_output_sample": (
        lambda s, d: v.check_output_sample(imp(s, d)),
        duck(
            """SELECT true AS has_columns, count(*) > 0 AS has_rows, count(*) FILTER ("Handle" <> '' AND "Title" <> '' AND "Vendor" <> '') AS complete_rows,
            count(*) FILTER ("Handle" <> '' AND "Title" <> '' AND "Vendor" <> '') > 0 AS passed FROM (SELECT * FROM imp ORDER BY row_no LIMIT 10)""",
            "imp",
        ),
    ),
    "product_listing": (
        lambda s, d: v.product_listing(imp(s, d)),
        duck(
            f"""SELECT row_no, "Handle" AS handle, {_brief('Title', 40)} AS title, "Option1 Name" AS option1_name, "Option1 Value" AS option1_value, "Option2 Name" AS option2_name,
            "Option2 Value" AS option2_value, "Option3 Name" AS option3_name, "Option3 Value" AS option3_value, {_brief('Image Src', 50)} AS image
            FROM imp WHERE "Handle" = (SELECT "Handle" FROM imp ORDER BY row_no LIMIT 1)""",
            "imp",
        ),
    ),
    "check_limits": (lambda s, d: v.check_limits(_limits(s, d)), _LIMITS_DUCK),
    "check_known_category": (
        lambda s, d: v.check_known_category(products(s, d).select("row_no", "category")),
        duck(
            "SELECT row_no, category FROM prod WHERE category NOT IN (" + ", ".join(f"'{c}'" for c in v.KNOWN_CATEGORIES) + ")",
            "prod",
        ),
    ),
}
