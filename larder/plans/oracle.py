"""SQL equivalents of the registered queries, for a second engine to check."""

from .queries import AS_OF, REF_DATE

ORACLE: dict[str, str] = {}

# Named sub-queries and what each needs; with_tables() emits them in order.
CTES: dict[str, tuple[list[str], str]] = {
    "item": ([], """
        SELECT CAST(p_partkey AS VARCHAR) AS upc_nbr, p_name AS item_dsc, p_size AS smic_class_cd,
               p_type AS smic_category_cd, split_part(p_name, ' ', 1) AS department_nm, p_name AS shelf_nm,
               replace(p_name, ' ', '/') AS health_clain_type_dsc,
               CASE WHEN p_partkey % 11 <> 0 THEN
                 '[["Calories", ' || (p_size * 6) || '], ["Added Sugar", ' || (p_partkey % 30)
                 || '], ["Fiber", ' || (p_partkey % 13) || ']]' END AS nutrition_nm,
               p_brand AS iri_brands_nm
        FROM part"""),
    "txn": ([], """
        SELECT CAST(o_custkey AS VARCHAR) AS household_id, CAST(l_partkey AS VARCHAR) AS upc_nbr,
               CAST(l_orderkey AS VARCHAR) AS txn_id, CAST(o_orderdate AS DATE) AS txn_date, l_quantity AS item_qount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "household": ([], """
        SELECT CAST(c_custkey AS VARCHAR) AS household_id, 'age_' || (c_nationkey % 5) AS age_group,
               c_mktsegment AS segment,
               CASE WHEN c_acctbal < 0 THEN 'low' WHEN c_acctbal < 5000 THEN 'mid' ELSE 'high' END AS income_group
        FROM customer"""),
    "nutrient": (["item"], """
        SELECT upc_nbr, lower(trim(pair[1])) AS name, TRY_CAST(pair[2] AS DOUBLE) AS value
        FROM (SELECT upc_nbr, unnest(from_json(nutrition_nm, '[["VARCHAR"]]')) AS pair
              FROM item WHERE nutrition_nm IS NOT NULL)"""),
    "bin": ([], """
        SELECT name, unnest(['low', 'medium', 'high']) AS level,
               unnest([0, a, b]) AS lo, unnest([a, b, c]) AS hi
        FROM (VALUES ('added sugar', 5, 15, 999), ('calories', 100, 200, 999), ('protein', 5, 15, 999),
                     ('sodium', 200, 500, 9999), ('total fat', 5, 15, 999), ('cholesterol', 10, 50, 999),
                     ('fiber', 3, 10, 999)) t(name, a, b, c)"""),
    "nutrition_map": (["nutrient", "bin"], """
        SELECT upc_nbr, 'nutrition_' || replace(n.name, ' ', '_') || '_' || level AS attr_id,
               CAST(1.0 AS DOUBLE) AS p_attr, 'nutrition_nm' AS evidence_sources
        FROM nutrient n JOIN bin b ON n.name = b.name AND n.value >= b.lo AND n.value < b.hi"""),
    "claim": (["item"], """
        SELECT DISTINCT upc_nbr, trim(c) AS claim
        FROM (SELECT upc_nbr, unnest(string_split(health_clain_type_dsc, '/')) AS c FROM item)"""),
    "raw_attr": (["item", "claim"], """
        SELECT upc_nbr, 'brand_' || lower(replace(iri_brands_nm, ' ', '_')) AS attr_id, 'brand' AS attr_family,
               iri_brands_nm AS display_name, 'iri_brands_nm' AS evidence_sources
        FROM item WHERE iri_brands_nm IS NOT NULL
        UNION ALL SELECT upc_nbr, 'category_' || smic_category_cd, 'category', CAST(smic_category_cd AS VARCHAR),
               'smic_category_cd' FROM item WHERE smic_category_cd IS NOT NULL
        UNION ALL SELECT upc_nbr, 'class_' || smic_class_cd, 'class', CAST(smic_class_cd AS VARCHAR),
               'smic_class_cd' FROM item WHERE smic_class_cd IS NOT NULL
        UNION ALL SELECT upc_nbr, 'dept_' || lower(replace(department_nm, ' ', '_')), 'department', department_nm,
               'department_nm' FROM item WHERE department_nm IS NOT NULL
        UNION ALL SELECT upc_nbr, 'shelf_' || lower(replace(shelf_nm, ' ', '_')), 'shelf', shelf_nm,
               'shelf_nm' FROM item WHERE shelf_nm IS NOT NULL
        UNION ALL SELECT upc_nbr, 'health_' || lower(replace(claim, ' ', '_')), 'health_claim', claim,
               'health_clain_type_dsc' FROM claim"""),
    "map": (["raw_attr", "nutrition_map"], """
        SELECT DISTINCT upc_nbr, attr_id, CAST(1.0 AS DOUBLE) AS p_attr, evidence_sources FROM raw_attr
        UNION ALL SELECT upc_nbr, attr_id, p_attr, evidence_sources FROM nutrition_map"""),
    "nutrition_vocab": (["bin"], """
        SELECT 'nutrition_' || replace(name, ' ', '_') || '_' || level AS attr_id, 'nutrition' AS attr_family,
               array_to_string(list_transform(string_split(name, ' '), lambda w: upper(w[1]) || w[2:]), ' ')
               || ' - ' || upper(level[1]) || level[2:] AS display_name
        FROM bin"""),
    "meta": (["raw_attr", "nutrition_vocab"], """
        SELECT DISTINCT attr_id, attr_family, display_name FROM raw_attr
        UNION ALL SELECT attr_id, attr_family, display_name FROM nutrition_vocab"""),
    "nutrition_wide": (["item", "nutrient"], """
        SELECT i.upc_nbr AS upc_id, max(value) FILTER (name = 'added sugar') AS added_sugar_g,
               max(value) FILTER (name = 'calories') AS calories, max(value) FILTER (name = 'fiber') AS fiber_g
        FROM item i LEFT JOIN nutrient n ON i.upc_nbr = n.upc_nbr GROUP BY i.upc_nbr"""),
    "joined": (["txn", "map"], "SELECT household_id, txn_date, item_qount, attr_id, p_attr FROM txn JOIN map USING (upc_nbr)"),
    "hist": (["joined"], """
        SELECT household_id, attr_id,
               sum(item_qount * p_attr * exp(-(date_diff('day', txn_date, (SELECT max(txn_date) FROM joined))) / 90.0))
                 AS hist_score,
               CAST(min(date_diff('day', txn_date, (SELECT max(txn_date) FROM joined))) AS BIGINT) AS last_seen_days
        FROM joined GROUP BY ALL HAVING hist_score > 0.01"""),
    "item_pair": (["map"], """
        SELECT a.attr_id AS src, b.attr_id AS dst, count(*) AS w
        FROM map a JOIN map b ON a.upc_nbr = b.upc_nbr AND a.attr_id < b.attr_id GROUP BY ALL"""),
    "hh_pair": (["hist"], """
        SELECT a.attr_id AS src, b.attr_id AS dst, sum(sqrt(a.hist_score * b.hist_score)) AS w
        FROM hist a JOIN hist b ON a.household_id = b.household_id AND a.attr_id < b.attr_id GROUP BY ALL"""),
    "item_cell": (["item_pair"], "SELECT src, dst, w FROM item_pair UNION ALL SELECT dst, src, w FROM item_pair"),
    "hh_cell": (["hh_pair"], "SELECT src, dst, w FROM hh_pair UNION ALL SELECT dst, src, w FROM hh_pair"),
    "vocab": (["map"], "SELECT DISTINCT attr_id FROM map"),
    "edge": (["item_pair", "hh_pair"], """
        SELECT src, dst, sum(w) AS w
        FROM (SELECT src, dst, CAST(w AS DOUBLE) AS w FROM item_pair UNION ALL SELECT src, dst, 0.5 * w FROM hh_pair)
        GROUP BY ALL HAVING sum(w) >= 3"""),
    "graph": (["edge", "vocab"], """
        SELECT src, dst, w FROM edge UNION ALL SELECT dst, src, w FROM edge
        UNION ALL SELECT attr_id, attr_id, 1.0 FROM vocab"""),
    "family_long": (["meta", "vocab"], """
        SELECT v.attr_id, f.pos, CAST(CASE WHEN m.attr_family = f.attr_family THEN 1 ELSE 0 END AS DOUBLE) AS value
        FROM vocab v LEFT JOIN (SELECT DISTINCT attr_id, attr_family FROM meta) m USING (attr_id)
        CROSS JOIN (SELECT attr_family, row_number() OVER (ORDER BY attr_family) - 1 AS pos
                    FROM (SELECT DISTINCT attr_family FROM meta)) f"""),
    "popularity_wide": (["map"], """
        SELECT attr_id, ln(1 + count(*)) AS p0, ln(1 + count(DISTINCT upc_nbr)) AS p1 FROM map GROUP BY attr_id"""),
    "popularity_long": (["popularity_wide"], """
        SELECT attr_id, 0 AS pos, p0 AS value FROM popularity_wide UNION ALL SELECT attr_id, 1, p1 FROM popularity_wide"""),
    "nutrition_mean": (["map", "nutrition_wide", "vocab"], """
        SELECT v.attr_id, coalesce(avg(added_sugar_g), 0) AS n0, coalesce(avg(calories), 0) AS n1,
               coalesce(avg(fiber_g), 0) AS n2
        FROM vocab v LEFT JOIN map m USING (attr_id) LEFT JOIN nutrition_wide n ON m.upc_nbr = n.upc_id GROUP BY ALL"""),
    "nutrition_long": (["nutrition_mean"], """
        SELECT attr_id, unnest([0, 1, 2]) AS pos,
               unnest([(n0 - (SELECT avg(n0) FROM nutrition_mean)) / ((SELECT stddev_pop(n0) FROM nutrition_mean) + 1e-6),
                       (n1 - (SELECT avg(n1) FROM nutrition_mean)) / ((SELECT stddev_pop(n1) FROM nutrition_mean) + 1e-6),
                       (n2 - (SELECT avg(n2) FROM nutrition_mean)) / ((SELECT stddev_pop(n2) FROM nutrition_mean) + 1e-6)
                      ]) AS value
        FROM nutrition_mean"""),
    "feature_long": (["family_long", "popularity_long", "nutrition_long"], """
        SELECT attr_id, pos, value FROM family_long
        UNION ALL SELECT attr_id, pos + (SELECT max(pos) + 1 FROM family_long), value FROM popularity_long
        UNION ALL SELECT attr_id, pos + (SELECT max(pos) + 3 FROM family_long), value FROM nutrition_long"""),
    "emb": ([], "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CAST(label AS VARCHAR) AS family FROM embeddings"),
    "item_vec": (["emb"], "SELECT CAST(p_partkey AS VARCHAR) AS item_id, v FROM part JOIN emb ON p_partkey = vec_id"),
    "attr_vec": (["vocab", "emb"], """
        SELECT attr_id, v FROM (SELECT attr_id, row_number() OVER (ORDER BY attr_id) - 1 AS idx FROM vocab)
        JOIN emb ON vec_id = (idx * 3) % (SELECT count(*) FROM emb)"""),
    "pos": (["map", "item_vec", "attr_vec"], """
        SELECT upc_nbr AS item_id, attr_id FROM map
        WHERE upc_nbr IN (SELECT item_id FROM item_vec) AND attr_id IN (SELECT attr_id FROM attr_vec)"""),
    "pop": (["map", "attr_vec"], """
        SELECT a.attr_id, coalesce(c.n, 1) AS n_rows
        FROM attr_vec a LEFT JOIN (SELECT attr_id, count(*) AS n FROM map GROUP BY attr_id) c USING (attr_id)"""),
    "lacking": (["pos", "pop"], """
        SELECT item_id, attr_id AS neg_attr, row_number() OVER w - 1 AS r, count(*) OVER (PARTITION BY item_id) AS free,
               sum(n_rows) OVER w - n_rows AS lo, sum(n_rows) OVER w AS hi, sum(n_rows) OVER (PARTITION BY item_id) AS weight
        FROM (SELECT i.item_id, p.attr_id, p.n_rows FROM (SELECT DISTINCT item_id FROM pos) i CROSS JOIN pop p
              WHERE NOT EXISTS (SELECT 1 FROM pos x WHERE x.item_id = i.item_id AND x.attr_id = p.attr_id))
        WINDOW w AS (PARTITION BY item_id ORDER BY attr_id)"""),
    "slot": (["pos"], "SELECT item_id, attr_id, unnest([0, 1, 2, 3, 4]) AS slot FROM pos"),
    "triple": (["slot", "lacking", "item_vec"], """
        SELECT CASE WHEN k.rk <= floor((SELECT count(*) FROM item_vec) * 0.8) THEN 'train' ELSE 'val' END AS split,
               s.item_id, s.attr_id AS pos_attr, s.slot, l.neg_attr
        FROM slot s JOIN lacking l ON s.item_id = l.item_id AND l.r = CAST('0x' || substr(md5(
               '42|0|' || s.item_id || '|' || s.attr_id || '|' || s.slot), 1, 15) AS BIGINT) % l.free
        JOIN (SELECT item_id, row_number() OVER (ORDER BY md5('42|' || item_id), item_id) AS rk FROM item_vec) k
          ON k.item_id = s.item_id"""),
    "w1": ([], """
        SELECT i, j, ((i * 7 + j * 3) % 11 - 5) / 10.0 AS w
        FROM (SELECT unnest(range(64)) AS i), (SELECT unnest(range(4)) AS j)"""),
    "aligned": (["attr_vec", "w1"], """
        SELECT attr_id, pos, o / sqrt(sum(o * o) OVER (PARTITION BY attr_id)) AS value FROM (
          SELECT attr_id, o.pos, sum(h * ((j * 5 + o.pos * 2) % 7 - 3) / 10.0) + (o.pos % 3) / 10.0 AS o FROM (
            SELECT attr_id, j,
                   (greatest(sum(x * w) + (j + 1) / 10.0, 0) - j / 10.0) / sqrt(1 + j / 4.0 + 1e-5) * (1 + j / 10.0)
                     + j / 20.0 AS h
            FROM (SELECT attr_id, unnest(v) AS x, unnest(range(64)) AS i FROM attr_vec) JOIN w1 USING (i)
            GROUP BY attr_id, j)
          CROSS JOIN (SELECT unnest(range(64)) AS pos) o GROUP BY attr_id, o.pos)"""),
    "aligned_vec": (["aligned"], "SELECT attr_id, list(value ORDER BY pos) AS a FROM aligned GROUP BY attr_id"),
    "score": (["item_vec", "emb"], """
        SELECT item_id, 'attr_' || e.vec_id AS attr_id, list_cosine_similarity(i.v, e.v) AS affinity_score
        FROM item_vec i CROSS JOIN emb e"""),
    "best": (["score"], """
        SELECT item_id, attr_id, affinity_score,
               CAST(row_number() OVER (PARTITION BY item_id ORDER BY affinity_score DESC, attr_id) AS INTEGER) AS rank
        FROM score QUALIFY rank <= 50"""),
    "provider": (["emb"], """
        SELECT 'attr_' || vec_id AS attr_id, family, 'plain' AS provider, v FROM emb
        UNION ALL SELECT 'attr_' || vec_id, family, 'reversed', list_reverse(v) FROM emb
        UNION ALL SELECT attr_id, family, 'weighted',
                         list_transform(d, lambda x: x / sqrt(list_dot_product(d, d))) FROM (
          SELECT 'attr_' || vec_id AS attr_id, family,
                 list_transform(v, lambda x, k: CASE WHEN k % 2 = 1 THEN x * 2.0 ELSE x END) AS d FROM emb)"""),
    "neighbor": (["provider"], """
        SELECT a.provider, a.attr_id, b.attr_id AS neighbor, a.family, b.family AS other_family,
               list_dot_product(a.v, b.v) AS score,
               CAST(row_number() OVER (PARTITION BY a.provider, a.attr_id
                                       ORDER BY list_dot_product(a.v, b.v) DESC, b.attr_id) AS INTEGER) AS rank
        FROM provider a JOIN provider b ON a.provider = b.provider AND a.attr_id <> b.attr_id QUALIFY rank <= 10"""),
    "norm": (["provider"], """
        SELECT provider, avg(n) AS norm_mean, stddev_pop(n) AS norm_std
        FROM (SELECT provider, sqrt(list_dot_product(v, v)) AS n FROM provider) GROUP BY provider"""),
    "sample": (["provider"], """
        SELECT attr_id, row_number() OVER (ORDER BY md5('42|' || attr_id), attr_id) AS pos
        FROM (SELECT DISTINCT attr_id FROM provider) QUALIFY pos <= 1000"""),
    "distance": (["provider", "sample"], """
        SELECT provider, count(*) AS n_distances, avg(d) AS dist_mean, stddev_pop(d) AS dist_std FROM (
          SELECT a.provider, list_distance(a.v, b.v) AS d,
                 row_number() OVER (PARTITION BY a.provider, a.attr_id ORDER BY sb.pos) AS nth
          FROM provider a JOIN sample sa ON a.attr_id = sa.attr_id
          JOIN provider b ON a.provider = b.provider AND a.attr_id <> b.attr_id JOIN sample sb ON b.attr_id = sb.attr_id)
        WHERE nth <= 100 GROUP BY provider"""),
}


def uniform(*parts: str) -> str:
    """The hash uniform of functions/hashing.py as SQL."""
    text = " || '|' || ".join(parts)
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) / 4294967296.0)"


def hash_int(*parts: str) -> str:
    text = " || '|' || ".join(parts)
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def with_tables(names: list[str], body: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][0]:
            visit(need)
        if name not in order:
            order.append(name)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    if order and body.lstrip().startswith("WITH "):
        return f"WITH {ctes},\n{body.lstrip()[5:]}"
    return f"WITH {ctes}\n{body}" if order else body


def oracle(key: str, needs: list[str], body: str) -> None:
    ORACLE[key] = with_tables(needs, body)


# ---- scans ---------------------------------------------------------------

oracle("scan_items", ["item"], "SELECT * FROM item")
oracle("scan_txn_window", ["txn"], f"SELECT * REPLACE (CAST(txn_date AS VARCHAR) AS txn_date) FROM txn WHERE txn_date >= DATE '{AS_OF}' - INTERVAL 2 YEAR")
oracle("scan_households", ["household"], "SELECT * FROM household")
oracle("table_counts", ["meta", "map", "txn", "hist", "nutrition_wide", "household"], """
    SELECT 'attr_meta' AS table_name, count(*) AS row_count FROM meta
    UNION ALL SELECT 'map_item_attribute', count(*) FROM map
    UNION ALL SELECT 'hh_item', count(*) FROM txn
    UNION ALL SELECT 'hh_attr_history', count(*) FROM hist
    UNION ALL SELECT 'item_nutrition', count(*) FROM nutrition_wide
    UNION ALL SELECT 'hh_meta', count(*) FROM household""")

# ---- vocabulary and map ----------------------------------------------------

oracle("attr_meta", ["meta"], "SELECT *, CAST(NULL AS VARCHAR) AS definition_json FROM meta")
oracle("attr_meta_health", ["claim"], """
    SELECT DISTINCT 'health_' || lower(replace(claim, ' ', '_')) AS attr_id, 'health_claim' AS attr_family,
           claim AS display_name FROM claim""")
oracle("attr_meta_nutrition", ["nutrition_vocab", "nutrition_map"], """
    SELECT v.attr_id, v.attr_family, v.display_name, count(m.upc_nbr) AS n_items
    FROM nutrition_vocab v LEFT JOIN nutrition_map m USING (attr_id) GROUP BY ALL""")
oracle("map_item_attribute", ["map"], "SELECT * FROM map")
oracle("map_health", ["claim"], """
    SELECT DISTINCT upc_nbr, 'health_' || lower(replace(claim, ' ', '_')) AS attr_id, CAST(1.0 AS DOUBLE) AS p_attr,
           'health_clain_type_dsc' AS evidence_sources FROM claim""")
oracle("map_nutrition_bins", ["nutrition_map"], "SELECT * FROM nutrition_map")
oracle("item_nutrition", ["nutrition_wide"], "SELECT * FROM nutrition_wide")
oracle("item_nutrition_pivot", ["nutrition_wide"], "SELECT * FROM nutrition_wide")
oracle("nutrition_text", [], """
    WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS upc_id, p_partkey % 9 AS form, CAST(p_size AS DOUBLE) AS s FROM part)
    SELECT upc_id, 'calories' AS nutrient, s AS value FROM p WHERE form IN (0, 1, 2, 3)
    UNION ALL SELECT upc_id, 'fiber', 2 FROM p WHERE form IN (0, 1)
    UNION ALL SELECT upc_id, 'it''s "x"', 0.5 FROM p WHERE form = 2
    UNION ALL SELECT upc_id, 'sodium', -100 FROM p WHERE form = 3
    UNION ALL SELECT upc_id, 'vitamin a (rae), total', s FROM p WHERE form = 4
    UNION ALL SELECT upc_id, 'a, none, b', NULL FROM p WHERE form = 4
    UNION ALL SELECT upc_id, 'calories', NULL FROM p WHERE form = 5
    UNION ALL SELECT upc_id, 'fiber', s FROM p WHERE form = 5
    UNION ALL SELECT upc_id, 'a', s FROM p WHERE form = 8""")
oracle("nutrition_long", ["nutrient"], "SELECT upc_nbr AS upc_id, name AS nutrient, value FROM nutrient")

# ---- household tables --------------------------------------------------------

oracle("hh_item", ["txn"], """
    SELECT household_id, upc_nbr AS upc_id, txn_id AS basket_id, CAST(txn_date AS TIMESTAMP) AS ts,
           item_qount AS quantity FROM txn""")
oracle("hh_item_daily_basket", ["txn"], """
    SELECT household_id, upc_nbr AS upc_id, household_id || '_' || CAST(txn_date AS VARCHAR) AS basket_id,
           CAST(txn_date AS TIMESTAMP) AS ts, item_qount AS quantity FROM txn""")
oracle("hh_attr_history", ["hist"], """
    SELECT household_id, attr_id, round(hist_score, 6) AS hist_score, last_seen_days FROM hist""")
oracle("hh_attr_history_refdate", ["joined"], f"""
    SELECT household_id, attr_id,
           round(sum(item_qount * p_attr * exp(-(date_diff('day', txn_date, DATE '{REF_DATE}')) / 365.0)), 5) AS hist_score,
           CAST(min(date_diff('day', txn_date, DATE '{REF_DATE}')) AS BIGINT) AS last_seen_days
    FROM joined GROUP BY household_id, attr_id
    HAVING sum(item_qount * p_attr * exp(-(date_diff('day', txn_date, DATE '{REF_DATE}')) / 365.0)) > 0.01""")
oracle("hh_attr_history_timestamps", ["txn", "map"], """
    WITH timed AS (SELECT household_id, item_qount, attr_id, p_attr,
                          CAST(txn_date AS TIMESTAMP) + to_hours(CAST(txn_id AS BIGINT) % 24) AS ts FROM txn JOIN map USING (upc_nbr)),
    aged AS (SELECT *, floor((epoch_us((SELECT max(ts) FROM timed)) - epoch_us(ts)) / 86400000000) AS days FROM timed)
    SELECT household_id, attr_id, round(sum(item_qount * p_attr * exp(-days / 90.0)), 6) AS hist_score,
           CAST(min(days) AS BIGINT) AS last_seen_days
    FROM aged GROUP BY ALL HAVING sum(item_qount * p_attr * exp(-days / 90.0)) > 0.01""")
oracle("history_top_attrs", ["hist"], """
    SELECT household_id, attr_id, round(hist_score, 6) AS hist_score, last_seen_days,
           CAST(row_number() OVER (PARTITION BY household_id ORDER BY round(hist_score, 6) DESC, attr_id) AS INTEGER) AS rank
    FROM hist
    QUALIFY row_number() OVER (PARTITION BY household_id ORDER BY round(hist_score, 6) DESC, attr_id) <= 5""")

# ---- co-occurrence -------------------------------------------------------------

oracle("cooc_item", ["item_pair"], "SELECT src, dst, w FROM item_pair")
oracle("cooc_household", ["hh_pair"], "SELECT src, dst, round(w, 4) AS w FROM hh_pair")
oracle("cooc_marginals", ["item_cell"], "SELECT src AS attr_id, CAST(sum(w) AS BIGINT) AS total FROM item_cell GROUP BY src")
oracle("cooc_stats", ["item_cell", "vocab"], """
    SELECT n AS attributes, c AS cells, CAST(t AS DOUBLE) AS total, round(100.0 * c / (n * n), 6) AS density_pct,
           round(100.0 - 100.0 * c / (n * n), 6) AS sparsity_pct
    FROM (SELECT count(*) AS c, sum(w) AS t FROM item_cell), (SELECT count(*) AS n FROM vocab)""")


def sppmi_sql(cells: str, shift: float, value: str = "round(w, 6)") -> str:
    return f"""
    SELECT src, dst, {value} AS w FROM (
      SELECT c.src, c.dst, ln(CAST(c.w AS DOUBLE) * t.t / (CAST(r.m AS DOUBLE) * k.m)) - {shift} AS w
      FROM {cells} c JOIN (SELECT src, sum(w) AS m FROM {cells} GROUP BY src) r ON c.src = r.src
      JOIN (SELECT src, sum(w) AS m FROM {cells} GROUP BY src) k ON c.dst = k.src
      CROSS JOIN (SELECT sum(w) AS t FROM {cells}) t) WHERE w > 0"""


oracle("sppmi_item", ["item_cell"], sppmi_sql("item_cell", 0.5))
oracle("sppmi_household", ["hh_cell"], sppmi_sql("hh_cell", 0.0))

# ---- graph -----------------------------------------------------------------------

oracle("attr_vocab", ["vocab"], "SELECT attr_id, row_number() OVER (ORDER BY attr_id) - 1 AS idx FROM vocab")
oracle("attr_graph", ["graph"], "SELECT src, dst, round(w, 4) AS w FROM graph")
oracle("attr_graph_item_only", ["item_pair", "vocab"], """
    SELECT src, dst, CAST(w AS DOUBLE) AS w FROM item_pair WHERE w >= 3
    UNION ALL SELECT dst, src, CAST(w AS DOUBLE) FROM item_pair WHERE w >= 3
    UNION ALL SELECT attr_id, attr_id, 1.0 FROM vocab""")
oracle("graph_stats", ["graph", "vocab"], """
    SELECT (SELECT count(*) FROM vocab) AS nodes, count(*) AS entries,
           count(*) FILTER (src < dst) AS undirected_edges,
           round(100.0 * count(*) / ((SELECT count(*) FROM vocab) * (SELECT count(*) FROM vocab)), 6) AS density_pct
    FROM graph""")
oracle("node_features_family", ["family_long"], "SELECT attr_id, CAST(pos AS BIGINT) AS pos, value FROM family_long")
oracle("node_features_popularity", ["popularity_long"],
       "SELECT attr_id, CAST(pos AS BIGINT) AS pos, round(value, 6) AS value FROM popularity_long")
oracle("node_features_nutrition", ["nutrition_long"],
       "SELECT attr_id, CAST(pos AS BIGINT) AS pos, round(value, 5) AS value FROM nutrition_long")
oracle("node_features", ["feature_long"],
       "SELECT attr_id, CAST(pos AS BIGINT) AS pos, round(value, 5) AS value FROM feature_long")
oracle("edge_dropout", ["graph"], f"""
    SELECT src, dst, round(w, 4) AS w FROM graph WHERE {uniform("'7'", "'1'", "src", "dst")} > 0.2""")
oracle("feature_mask", ["feature_long"], f"""
    SELECT attr_id, CAST(pos AS BIGINT) AS pos,
           CASE WHEN {uniform("'7'", "'1'", "attr_id", "CAST(pos AS VARCHAR)")} > 0.1 THEN round(value, 5) ELSE 0.0 END AS value
    FROM feature_long""")
oracle("denoise_mask", ["item_cell"], f"""
    SELECT src, dst, w FROM item_cell WHERE {uniform("'7'", "'3'", "src", "dst")} > 0.2""")
oracle("neighbor_mean", ["graph", "popularity_long"], """
    SELECT g.dst AS attr_id, CAST(p.pos AS BIGINT) AS pos, round(sum(g.w * p.value) / greatest(sum(g.w), 1.0), 6) AS value
    FROM graph g JOIN popularity_long p ON g.src = p.attr_id GROUP BY g.dst, p.pos""")

# ---- vectors and the store -------------------------------------------------------------

oracle("l2_normalize", ["emb"], """
    SELECT 'attr_' || vec_id AS attr_id, CAST(pos AS BIGINT) AS pos,
           round(x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)), 6) AS value
    FROM (SELECT vec_id, pos, y * (pos + 1) AS x
          FROM (SELECT vec_id, unnest(v) AS y, unnest(range(len(v))) AS pos FROM emb))""")
oracle("vector_store_write_read", ["provider"], """
    SELECT attr_id, provider, 'reversed_2024-05-01' AS model_version, 'v1' AS vocab_version, 'test' AS built_from,
           CAST(len(v) AS BIGINT) AS dim, round(v[1], 6) AS first_value, round(sqrt(list_dot_product(v, v)), 6) AS norm,
           '2024-05-01 00:00:00' AS created_at
    FROM provider WHERE provider = 'reversed'""")
oracle("vector_store_latest", ["provider"], """
    SELECT attr_id, provider, provider || '_2024-05-01' AS model_version, 'v1' AS vocab_version, 'test' AS built_from,
           CAST(len(v) AS BIGINT) AS dim, round(v[1], 6) AS first_value, round(sqrt(list_dot_product(v, v)), 6) AS norm,
           '2024-05-01 00:00:00' AS created_at
    FROM provider""")
oracle("frozen_item_vectors", ["emb"], """
    SELECT 'sku_' || p_partkey AS item_id, round(v[1], 6) AS first_value FROM part JOIN emb ON p_partkey = vec_id
    UNION ALL SELECT 'item_' || vec_id, round(v[1], 6) FROM emb""")
oracle("infonce_loss", ["emb"], """
    SELECT round(avg(lse - pos), 6) AS loss, count(*) AS n_anchors FROM (
      SELECT a.id, a.view, ln(sum(exp(list_dot_product(a.u, b.u) / 0.5)) FILTER (a.id <> b.id OR a.view <> b.view)) AS lse,
             max(list_dot_product(a.u, b.u) / 0.5) FILTER (a.id = b.id AND a.view <> b.view) AS pos
      FROM (SELECT vec_id AS id, 1 AS view, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM emb
            UNION ALL SELECT vec_id, 2, list_reverse(list_transform(v, lambda x: x / sqrt(list_dot_product(v, v)))) FROM emb) a
      CROSS JOIN (SELECT vec_id AS id, 1 AS view, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM emb
            UNION ALL SELECT vec_id, 2, list_reverse(list_transform(v, lambda x: x / sqrt(list_dot_product(v, v)))) FROM emb) b
      GROUP BY a.id, a.view)""")

# ---- samples ---------------------------------------------------------------------------------

oracle("positive_samples", ["pos"], "SELECT * FROM pos")
oracle("attr_popularity", ["pop"], """
    SELECT attr_id, CAST(n_rows AS BIGINT) AS n_rows, round(n_rows / (SELECT sum(n_rows) FROM pop), 8) AS probability FROM pop""")
DRAW = hash_int("'42'", "'1'", "s.item_id", "s.attr_id", "s.slot")
oracle("negatives_uniform", ["slot", "lacking"], f"""
    SELECT s.item_id, s.attr_id, CAST(s.slot AS BIGINT) AS slot, l.neg_attr
    FROM slot s JOIN lacking l ON s.item_id = l.item_id AND l.r = {DRAW} % l.free""")
oracle("negatives_popularity", ["slot", "lacking"], f"""
    SELECT s.item_id, s.attr_id, CAST(s.slot AS BIGINT) AS slot, l.neg_attr
    FROM slot s JOIN lacking l ON s.item_id = l.item_id
     AND {DRAW} % CAST(l.weight AS BIGINT) >= l.lo AND {DRAW} % CAST(l.weight AS BIGINT) < l.hi""")
oracle("train_val_split", ["item"], """
    SELECT upc_nbr AS item_id,
           CASE WHEN row_number() OVER (ORDER BY md5('42|' || upc_nbr), upc_nbr) <= floor((SELECT count(*) FROM item) * 0.8)
                THEN 'train' ELSE 'val' END AS split FROM item""")
oracle("training_triples", ["triple"], "SELECT * REPLACE (CAST(slot AS BIGINT) AS slot) FROM triple")
oracle("item_profiles", ["pos"], "SELECT item_id, string_agg(attr_id, ',' ORDER BY attr_id) AS attrs FROM pos GROUP BY item_id")

# ---- alignment with fixed weights ----------------------------------------------------------------

oracle("align_forward", ["aligned"], "SELECT attr_id, CAST(pos AS BIGINT) AS pos, round(value, 6) AS value FROM aligned")
oracle("align_logits", ["triple", "aligned_vec", "item_vec"], """
    SELECT t.item_id, t.pos_attr, CAST(t.slot AS BIGINT) AS slot,
           round(list_cosine_similarity(i.v, a.a) / 0.07, 5) AS logit
    FROM (SELECT item_id, pos_attr, slot + 1 AS slot, neg_attr AS attr_id FROM triple
          UNION ALL SELECT DISTINCT item_id, pos_attr, 0, pos_attr FROM triple) t
    JOIN aligned_vec a ON a.attr_id = t.attr_id JOIN item_vec i ON i.item_id = t.item_id""")

# ---- affinity ----------------------------------------------------------------------------------------

oracle("affinity_scores", ["score"], "SELECT item_id, attr_id, round(affinity_score, 6) AS affinity_score FROM score")
for _key in ("affinity_topk", "affinity_topk_blocks"):
    oracle(_key, ["best"], "SELECT item_id, attr_id, round(affinity_score, 6) AS affinity_score, rank FROM best")
oracle("affinity_summary", ["best"], """
    SELECT count(*) AS n_rows, round(avg(affinity_score), 6) AS mean_score, round(min(affinity_score), 6) AS min_score,
           round(max(affinity_score), 6) AS max_score, count(DISTINCT item_id) AS n_items,
           count(DISTINCT attr_id) AS n_attributes, round(count(*) / count(DISTINCT item_id), 6) AS rows_per_item
    FROM best""")
oracle("affinity_sample", ["best"], """
    SELECT item_id, attr_id, round(affinity_score, 6) AS affinity_score, rank FROM best ORDER BY item_id, rank LIMIT 20""")
oracle("household_affinity_topk", ["hist", "attr_vec"], """
    WITH profile AS (
      SELECT household_id, list(x ORDER BY i) AS v FROM (
        SELECT household_id, i, sum(hist_score * x) AS x
        FROM (SELECT h.household_id, h.hist_score, unnest(a.v) AS x, unnest(range(len(a.v))) AS i
              FROM hist h JOIN attr_vec a USING (attr_id)) GROUP BY household_id, i) GROUP BY household_id)
    SELECT household_id, attr_id, round(score, 6) AS affinity_score, CAST(rank AS INTEGER) AS rank FROM (
      SELECT p.household_id, a.attr_id, list_cosine_similarity(p.v, a.v) AS score,
             row_number() OVER (PARTITION BY p.household_id ORDER BY list_cosine_similarity(p.v, a.v) DESC, a.attr_id) AS rank
      FROM profile p CROSS JOIN attr_vec a) WHERE rank <= 10""")

# ---- encoders with fixed weights ------------------------------------------------------------------------


def pattern(i: str, j: str, a: int, b: int, c: int, m: int) -> str:
    """The weight at row i, column j of the queries' fixed matrices."""
    return f"((({i}) * {a} + ({j}) * {b} + {c}) % {m} - {m // 2}) / 10.0"


for _key in ("ae_encode_fixed", "ae_encode_blocks"):
    oracle(_key, ["item_cell", "vocab"], f"""
    WITH idx AS (SELECT attr_id, row_number() OVER (ORDER BY attr_id) - 1 AS i FROM vocab),
    w AS ({sppmi_sql("item_cell", 0.5, "w")}),
    hid AS (SELECT v.attr_id, j, greatest(coalesce(sum(w.w * ({pattern("d.i", "j", 7, 3, 0, 11)})), 0) + (j + 1) / 10.0, 0) AS h
            FROM vocab v CROSS JOIN (SELECT unnest(range(4)) AS j) LEFT JOIN w ON w.src = v.attr_id LEFT JOIN idx d ON d.attr_id = w.dst
            GROUP BY v.attr_id, j),
    z AS (SELECT attr_id, pos, sum(h * ({pattern("j", "pos", 5, 2, 1, 7)})) + pos / 20.0 AS z
          FROM hid CROSS JOIN (SELECT unnest(range(3)) AS pos) GROUP BY attr_id, pos)
    SELECT attr_id, CAST(pos AS BIGINT) AS pos,
           round(z / CASE WHEN sum(z * z) OVER p = 0 THEN 1 ELSE sqrt(sum(z * z) OVER p) END, 5) AS value
    FROM z WINDOW p AS (PARTITION BY attr_id)""")


def convolution(before: str, layer: int, width: int) -> str:
    """A layer of the graph encoder on (attr_id, i, h) rows: normalised linear maps of a node and of its neighbours' mean."""
    own, mean = pattern("b.i", "j", 2, 3, layer, 5), pattern("n.i", "j", 3, 1, layer, 7)
    return f"""
      SELECT attr_id, j, (p - j / 10.0) / sqrt(1 + j / 4.0 + 1e-5) * (1 + j / 10.0) + j / 20.0 AS y FROM (
        SELECT attr_id, j, sum(v) + (j + {layer}) / 20.0 + j / 30.0 AS p FROM (
          SELECT b.attr_id, j, b.h * ({own}) AS v FROM {before} b CROSS JOIN (SELECT unnest(range({width})) AS j)
          UNION ALL SELECT n.attr_id, j, n.h * ({mean}) FROM (
            SELECT g.dst AS attr_id, b.i, sum(g.w * b.h) / greatest(sum(g.w), 1.0) AS h
            FROM graph g JOIN {before} b ON g.src = b.attr_id GROUP BY g.dst, b.i) n CROSS JOIN (SELECT unnest(range({width})) AS j))
        GROUP BY attr_id, j)"""


oracle("graph_encode_fixed", ["feature_long", "graph"], f"""
    WITH h0 AS (SELECT attr_id, j AS i, greatest(sum(value * ({pattern("f.pos", "j", 5, 3, 0, 7)})) + (j + 1) / 10.0, 0) AS h
                FROM feature_long f CROSS JOIN (SELECT unnest(range(3)) AS j) GROUP BY attr_id, j),
    y1 AS ({convolution("h0", 1, 3)}),
    h1 AS (SELECT h0.attr_id, h0.i, h0.h + greatest(y1.y, 0) AS h FROM h0 JOIN y1 ON h0.attr_id = y1.attr_id AND h0.i = y1.j),
    y2 AS ({convolution("h1", 2, 2)})
    SELECT attr_id, CAST(j AS BIGINT) AS pos, round(y, 5) AS value FROM y2""")

# ---- comparison of providers ------------------------------------------------------------------------------

oracle("provider_similarity", ["provider"], """
    WITH asked AS (SELECT unnest(['plain', 'reversed', 'weighted', 'absent']) AS p)
    SELECT x.p AS provider_a, y.p AS provider_b, round(avg(list_cosine_similarity(a.v, b.v)), 6) AS mean_cosine
    FROM asked x CROSS JOIN asked y LEFT JOIN provider a ON a.provider = x.p
    LEFT JOIN provider b ON b.provider = y.p AND b.attr_id = a.attr_id GROUP BY ALL""")
oracle("common_attrs", ["provider"], """
    SELECT attr_id FROM provider
    WHERE NOT (provider = 'plain' AND family = '0') AND NOT (provider = 'reversed' AND family = '1')
    GROUP BY attr_id HAVING count(DISTINCT provider) = 3""")
for _key in ("nearest_neighbors", "nearest_neighbors_blocks"):
    oracle(_key, ["neighbor"], "SELECT provider, attr_id, neighbor, round(score, 6) AS score, rank FROM neighbor")
oracle("coherence", ["neighbor"], """
    SELECT provider, count(*) AS n_neighbors, count(*) FILTER (family = other_family) AS n_same_family,
           round(count(*) FILTER (family = other_family) / count(*), 6) AS coherence FROM neighbor GROUP BY provider""")
oracle("norm_stats", ["norm"], """
    SELECT provider, round(norm_mean, 5) AS norm_mean, round(norm_std, 5) AS norm_std FROM norm""")
oracle("distance_stats", ["distance"], """
    SELECT provider, n_distances, round(dist_mean, 6) AS dist_mean, round(dist_std, 6) AS dist_std FROM distance""")
oracle("distance_stats_sampled", ["provider", "sample"], """
    SELECT provider, count(*) AS n_distances, round(avg(d), 6) AS dist_mean, round(stddev_pop(d), 6) AS dist_std FROM (
      SELECT a.provider, list_distance(a.v, b.v) AS d,
             row_number() OVER (PARTITION BY a.provider, a.attr_id ORDER BY sb.pos) AS nth
      FROM provider a JOIN sample sa ON a.attr_id = sa.attr_id AND sa.pos <= 120
      JOIN provider b ON a.provider = b.provider AND a.attr_id <> b.attr_id
      JOIN sample sb ON b.attr_id = sb.attr_id AND sb.pos <= 120)
    WHERE nth <= 30 GROUP BY provider""")
oracle("provider_verdicts", ["norm", "distance"], """
    SELECT provider, round(norm_mean, 5) AS norm_mean, round(dist_std / dist_mean, 5) AS spread,
           CASE WHEN norm_mean BETWEEN 0.95 AND 1.05 THEN 'normalized' ELSE 'not normalized' END AS norm_verdict,
           CASE WHEN dist_std / dist_mean < 0.2 THEN 'clustered' ELSE 'spread' END AS spread_verdict
    FROM norm JOIN distance USING (provider)""")

# ---- training: what does not depend on the weights that are learnt ---------------------------------------

oracle("sampled_neighborhoods", ["graph", "vocab"], """
    WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY dst ORDER BY md5('42|0|' || src || '|' || dst), src) AS place FROM graph),
    seed AS (SELECT (row_number() OVER (ORDER BY attr_id) - 1) // 16 AS batch, attr_id AS node FROM vocab),
    one AS (SELECT s.batch, r.src, r.dst, r.w FROM seed s JOIN ranked r ON r.dst = s.node AND r.place <= 3),
    met AS (SELECT DISTINCT batch, src AS node FROM one EXCEPT SELECT batch, node FROM seed),
    two AS (SELECT m.batch, r.src, r.dst, r.w FROM met m JOIN ranked r ON r.dst = m.node AND r.place <= 2)
    SELECT batch, src, dst, round(w, 4) AS w FROM one UNION ALL SELECT batch, src, dst, round(w, 4) FROM two""")
oracle("best_epoch", [], """
    WITH h AS (SELECT CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS epoch, count(*) / 100.0 AS loss FROM orders GROUP BY 1)
    SELECT epoch, loss AS val_loss FROM h WHERE epoch % 3 <> 0 ORDER BY loss, epoch LIMIT 1""")
oracle("params_written", [], """
    WITH n AS (SELECT c_nationkey, row_number() OVER (ORDER BY c_nationkey) - 1 AS i FROM (SELECT DISTINCT c_nationkey FROM customer)),
    s AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS j, count(*) OVER () AS width FROM (SELECT DISTINCT c_mktsegment FROM customer)),
    c AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL)
    SELECT 'segments' AS name, (SELECT count(*) FROM n) || 'x' || width AS shape, CAST(i * width + j AS INTEGER) AS at,
           CAST(coalesce(c.n, 0) AS DOUBLE) AS value
    FROM n CROSS JOIN s LEFT JOIN c USING (c_nationkey, c_mktsegment)
    UNION ALL SELECT 'nations', CAST((SELECT count(*) FROM n) AS VARCHAR), CAST(i AS INTEGER), CAST(c_nationkey AS DOUBLE) FROM n""")

# ---- whole runs ------------------------------------------------------------------------------------------

oracle("full_etl", ["meta", "map", "txn", "household", "nutrition_wide"], f"""
    WITH recent AS (SELECT * FROM txn WHERE txn_date >= DATE '{AS_OF}' - INTERVAL 2 YEAR),
    scored AS (
      SELECT household_id, attr_id FROM recent JOIN map USING (upc_nbr) GROUP BY ALL
      HAVING sum(item_qount * p_attr * exp(-(date_diff('day', txn_date,
               (SELECT max(txn_date) FROM recent JOIN map USING (upc_nbr)))) / 90.0)) > 0.01)
    SELECT 'attr_meta' AS table_name, count(*) AS row_count FROM meta
    UNION ALL SELECT 'map_item_attribute', count(*) FROM map
    UNION ALL SELECT 'hh_item', count(*) FROM recent
    UNION ALL SELECT 'hh_attr_history', count(*) FROM scored
    UNION ALL SELECT 'item_nutrition', count(*) FROM nutrition_wide
    UNION ALL SELECT 'hh_meta', count(*) FROM household""")
oracle("etl_written_map", ["map"], "SELECT * FROM map")
oracle("etl_written_history", ["txn", "map"], f"""
    WITH recent AS (SELECT * FROM txn JOIN map USING (upc_nbr) WHERE txn_date >= DATE '{AS_OF}' - INTERVAL 2 YEAR),
    aged AS (SELECT *, date_diff('day', txn_date, (SELECT max(txn_date) FROM recent)) AS days FROM recent)
    SELECT household_id, attr_id, round(sum(item_qount * p_attr * exp(-days / 90.0)), 6) AS hist_score,
           CAST(min(days) AS BIGINT) AS last_seen_days
    FROM aged GROUP BY ALL HAVING sum(item_qount * p_attr * exp(-days / 90.0)) > 0.01""")

CTES["written"] = (["txn", "map"], f"""
    SELECT household_id, attr_id FROM (SELECT * FROM txn WHERE txn_date >= DATE '{AS_OF}' - INTERVAL 2 YEAR) JOIN map USING (upc_nbr) GROUP BY ALL
    HAVING sum(item_qount * p_attr * exp(-(date_diff('day', txn_date, (
      SELECT max(txn_date) FROM txn JOIN map USING (upc_nbr) WHERE txn_date >= DATE '{AS_OF}' - INTERVAL 2 YEAR))) / 90.0)) > 0.01""")
oracle("run_providers", ["written", "vocab"], """
    SELECT 'cooc_ae_item' AS provider, attr_id, 64 AS dim FROM vocab
    UNION ALL SELECT DISTINCT 'cooc_ae_hh', attr_id, 64 FROM written
    UNION ALL SELECT 'gcl', attr_id, 64 FROM (SELECT attr_id FROM vocab UNION SELECT attr_id FROM written)""")
oracle("retail_pipeline_counts", ["written", "vocab", "item_vec"], """
    SELECT 'item' AS side, count(*) AS n_items, CAST(count(*) * least(50, (SELECT count(*) FROM vocab)) AS BIGINT) AS n_rows FROM item_vec
    UNION ALL SELECT 'household', count(DISTINCT household_id), CAST(count(DISTINCT household_id) * least(50, (SELECT count(*) FROM vocab)) AS BIGINT)
    FROM written""")
