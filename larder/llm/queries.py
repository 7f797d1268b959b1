"""The registered queries of the operators: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import decontaminate, fingerprint, html_blocks, language, merkle, ngram_join, packing, secrets, sharding, simhash, substring_dedup, token_alignment, token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
SHARDS = [f"shard-{i:02d}" for i in range(16)]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_html(spark, sf_dir):
    return html_blocks.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def op2_substring_dedup(spark, sf_dir):
    kept = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op2_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
     s AS (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50),
     k AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS key FROM s),
     f AS (SELECT key, min(doc_id) AS first FROM k GROUP BY key),
     r AS (SELECT DISTINCT k.doc_id, unnest(range(i, i + 50)) AS p FROM k JOIN f USING (key) WHERE k.doc_id > f.first),
     g AS (SELECT doc_id, list(p) AS gone FROM r GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(list_filter(words, lambda x, p: gone IS NULL OR NOT list_contains(gone, p)), ' '), '')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id)
"""


@query
def op3_secrets(spark, sf_dir):
    return secrets.scan(documents(spark, sf_dir))


def _secret_sql() -> str:
    """op3 in another engine: the rules, the battery of tests and the limits."""
    quote = lambda p: "'" + p.replace("'", "''") + "'"
    def hits(table: str, rank: int, kind: str, pattern: str) -> str:
        return f"""SELECT doc_id, '{kind}' AS kind, {rank} AS rank, hits[i] AS hit,
                          (sum(len(gaps[i]) + len(hits[i])) OVER (PARTITION BY doc_id ORDER BY i) - len(hits[i]))::BIGINT AS a
                   FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (
                         SELECT doc_id, regexp_extract_all(text, {quote(pattern)}) AS hits, string_split_regex(text, {quote(pattern)}) AS gaps FROM {table}))"""

    rules = " UNION ALL ".join(hits("d", r, k, p) for r, (k, p, *_) in enumerate(secrets.KINDS))
    alphabet = " ".join(f"WHEN '{k}' THEN '{a}'" for k, a in secrets.ALPHABETS.items())
    band = " + ".join(f"(len(hit) >= {b})::INTEGER" for b in secrets.BANDS)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS ({rules}),
base AS (SELECT doc_id, kind, rank, a, a + len(hit) AS b FROM s
         WHERE (kind = 'assign' AND len(regexp_extract(hit, {quote(secrets.KINDS[0][1])}, 2)) >= 6) OR (kind = 'access' AND len(hit) >= 20) OR kind = 'hex'),
laid AS (SELECT *, coalesce(max(b) OVER (PARTITION BY doc_id ORDER BY a, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM base),
rest AS (SELECT doc_id, string_agg(substr(text, done + 1, greatest(a - done, 0)) || repeat(' ', greatest(b - greatest(done, a), 0)), '' ORDER BY a, rank)
                        || substr(any_value(text), max(b) + 1) AS text FROM laid JOIN d USING (doc_id) GROUP BY doc_id
         UNION ALL SELECT doc_id, text FROM d ANTI JOIN base USING (doc_id)),
run AS (SELECT *, CASE WHEN regexp_full_match(hit, '[0-9a-f]+|[0-9A-F]+') THEN 'base16' WHEN regexp_full_match(hit, '[A-Z2-7]+=*') THEN 'base32'
                       WHEN regexp_full_match(hit, '[0-9a-z]+|[0-9A-Z]+') THEN 'base36' WHEN regexp_full_match(hit, '[0-9A-Za-z]+') THEN 'base62' ELSE 'base64' END AS code
        FROM ({hits('rest', 3, 'random', secrets.CANDIDATE)}) WHERE regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]')),
sym AS (SELECT doc_id, a, a + len(hit) AS b, {band} AS band, len(letters)::DOUBLE AS k,
               list_transform(string_split(CASE WHEN code IN ('base16', 'base36') THEN lower(plain) ELSE plain END, ''), lambda c: instr(letters, c) - 1) AS x
        FROM (SELECT *, CASE code {alphabet} END AS letters, translate(rtrim(hit, '='), '-_', '+/') AS plain FROM run)),
cel AS (SELECT *, least(k, greatest(2.0, floor(len(x) / {secrets.PER_CELL}.0))) AS m, len(x)::DOUBLE AS n FROM sym),
stat AS (SELECT *, greatest(list_sum(list_transform(range(m::BIGINT), lambda c: pow(len(list_filter(x, lambda v: floor(v * m / k) = c)), 2)
                                                     / ((ceil((c + 1) * k / m) - ceil(c * k / m)) / k))) / n - n, 0) AS chi,
                list_sum(list_transform(range(1, len(x)), lambda i: ((x[i] * 2 >= k) <> (x[i + 1] * 2 >= k))::INTEGER)) AS turns,
                list_sum(list_transform(range(1, len(x)), lambda i: (x[i] - (k - 1) / 2) * (x[i + 1] - (k - 1) / 2))) AS prod FROM cel),
z AS (SELECT *, (pow((pow(chi / (m - 1), 1.0 / 3) - (1 - 2 / (9 * (m - 1)))) / sqrt(2 / (9 * (m - 1))), 2)
                 + pow((turns - (n - 1) / 2) / sqrt((n - 1) / 4), 2) + pow(prod / ((k * k - 1) / 12) / sqrt(n - 1), 2)) / 2 AS h FROM stat),
t AS (SELECT *, 1 / (1 + 0.3275911 * sqrt(h)) AS t FROM z),
p AS (SELECT doc_id, a, b, band, t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * exp(-h)
                               + sqrt(h) * 1.1283791670955126 * exp(-h) AS p FROM t),
step AS (SELECT *, least(ceil((ln(greatest(p, exp({secrets.LEAST_LOG}))) - ({secrets.LEAST_LOG})) / {-secrets.LEAST_LOG} * {secrets.STEPS}), {secrets.STEPS})::INTEGER AS step FROM p),
cum AS (SELECT band, step, sum(count(*)) OVER (PARTITION BY band ORDER BY step) AS k, sum(count(*)) OVER (PARTITION BY band) AS m FROM step GROUP BY band, step),
lim AS (SELECT band, max(step) AS lim FROM cum WHERE exp((step / {secrets.STEPS}.0 - 1) * {-secrets.LEAST_LOG}) <= {secrets.LEVEL} * k / m GROUP BY band),
rnd AS (SELECT doc_id, 'random' AS kind, 3 AS rank, a, b FROM step LEFT JOIN lim USING (band) WHERE step > coalesce(lim, -1)),
every AS (SELECT * FROM base UNION ALL SELECT * FROM rnd),
agg AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
               count(*) FILTER (kind = 'random') AS n_random, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) FILTER (rank < 3) AS base,
               string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) AS spans FROM every GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, coalesce(n_random, 0) AS n_random,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN agg USING (doc_id)
"""


ORACLE["op3_secrets"] = _secret_sql()


@query
def op4_token_files(spark, sf_dir):
    return token_files.read(token_files.write(documents(spark, sf_dir), vocabulary()))


@query
def op5_fingerprint(spark, sf_dir):
    return fingerprint.compare_with_next(documents(spark, sf_dir))


def _fingerprint_sql() -> str:
    """op5 in another engine: bytes as rows, triplet hashes from the same rule, quartiles and differences as lists."""
    d = fingerprint
    seeds = ", ".join(f"max(v) FILTER (i // 256 = {3 * k + p}) AS s{k}{p}" for k in range(3) for p in range(3))
    letters = "wxyz"
    hashes = ", ".join(
        f"xor(({letters[a]}.s{k}0 + {letters[b]}.s{k}1) % 4294967296, {letters[c]}.s{k}2)" for k, (a, b, c) in enumerate(d.TRIPLETS))
    seen = " ".join(f"LEFT JOIN seeds {v} ON {v}.byte = r.{v}" for v in letters)
    unlike = lambda x, y: (
        f"1.0::DOUBLE - least({d.UNLIKE}, list_sum(list_transform(range(1, {d.BUCKETS + 1}), lambda i: [0, 1, 2, 6][abs({x}.codes[i] - {y}.codes[i]) + 1]))"
        f" + abs({x}.size - {y}.size) + abs({x}.low - {y}.low) + abs({x}.mid - {y}.mid))::DOUBLE / {d.UNLIKE}")
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT *, coalesce(lead(t) OVER o, first_value(t) OVER o) AS u FROM d WINDOW o AS (ORDER BY doc_id DESC NULLS LAST, t)),
e AS (SELECT *, substr(t, 1, len(t) - len(t) // 3) || substr(u, 1, len(t) // 3) AS v FROM n),
s AS MATERIALIZED (SELECT t, row_number() OVER () AS k FROM (SELECT t FROM e UNION SELECT v FROM e)),
b AS (SELECT k, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: ('0x' || h)::INTEGER) AS bytes FROM s),
m0 AS (SELECT i, (i + 1)::UBIGINT AS x FROM range(2304) r(i)),
m1 AS (SELECT i, (xor(x, x >> 30)::UHUGEINT * {0xBF58476D1CE4E5B9}::UHUGEINT % 18446744073709551616::UHUGEINT)::UBIGINT AS x FROM m0),
m2 AS (SELECT i, (xor(x, x >> 27)::UHUGEINT * {0x94D049BB133111EB}::UHUGEINT % 18446744073709551616::UHUGEINT)::UBIGINT AS x FROM m1),
seeds AS (SELECT byte, {seeds} FROM (SELECT i, i % 256 AS byte, xor(x, x >> 31) % 4294967296 AS v FROM m2) GROUP BY byte),
r AS (SELECT k, unnest(bytes) AS w, unnest(bytes[2:]) AS x, unnest(bytes[3:]) AS y, unnest(bytes[4:]) AS z FROM b),
h AS (SELECT k, unnest([{hashes}]) AS h FROM r {seen}),
c AS (SELECT k, (h::UBIGINT * 2654435761 % 4294967296) >> 25 AS bucket, count(*) AS n FROM h WHERE h IS NOT NULL GROUP BY ALL),
l AS (SELECT s.k, list(coalesce(c.n, 0) ORDER BY g.bucket) AS counts FROM s CROSS JOIN (SELECT range::UBIGINT AS bucket FROM range({d.BUCKETS})) g LEFT JOIN c ON c.k = s.k AND c.bucket = g.bucket GROUP BY s.k),
q AS (SELECT t, counts, list_sort(counts) AS o FROM l JOIN s USING (k)),
f AS (SELECT t, list_transform(counts, lambda c: (c > o[{d.BUCKETS // 4}])::INTEGER + (c > o[{d.BUCKETS // 2}])::INTEGER + (c > o[{3 * d.BUCKETS // 4}])::INTEGER) AS codes,
             floor(least(255, ln(greatest(octet_length(encode(t)), 1)) / ln(1.1)))::INTEGER AS size,
             least(15, o[{d.BUCKETS // 4}] * 16 // greatest(o[{3 * d.BUCKETS // 4}], 1)) AS low, least(15, o[{d.BUCKETS // 2}] * 16 // greatest(o[{3 * d.BUCKETS // 4}], 1)) AS mid FROM q),
p AS (SELECT *, printf('%02x%02x', size, (low * 16 + mid)::INTEGER) || array_to_string(list_transform(range(0, {d.BUCKETS // 4}), lambda i:
             printf('%02x', codes[4 * i + 1] + 4 * codes[4 * i + 2] + 16 * codes[4 * i + 3] + 64 * codes[4 * i + 4])), '') AS mark FROM f)
SELECT doc_id, len(e.t)::BIGINT AS n_chars, sha256(e.v) AS edited_sha256, a.mark AS fingerprint, b.mark AS edited_fingerprint,
       {unlike("a", "b")} AS near_edited, {unlike("a", "c")} AS near_next
FROM e JOIN p a ON a.t = e.t JOIN p b ON b.t = e.v JOIN p c ON c.t = e.u
"""


ORACLE["op5_fingerprint"] = _fingerprint_sql()


@query
def op6_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(documents(spark, sf_dir))


ORACLE["op6_ngram_join"] = r"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(words[i:i + 4], ' ')) AS g
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(min(r.c), w.doc_id)::BIGINT AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) GROUP BY w.doc_id, n.n
"""


@query
def op7_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return language.predict(docs, language.train(docs))


@query
def op8_decontamination(spark, sf_dir):
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op9_sharding(spark, sf_dir):
    rows = sharding.write(documents(spark, sf_dir), SHARDS)
    return rows.select("doc_id", "slot", "shard", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


ORACLE["op9_sharding"] = f"""
WITH t AS (SELECT [{", ".join(map(str, sharding.lookup_table(SHARDS)))}] AS seats),
     d AS (SELECT doc_id, text, ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT % {sharding.SLOTS} AS slot FROM documents)
SELECT doc_id, slot, printf('shard-%02d', seats[slot + 1]) AS shard, sha256(coalesce(text, '')) AS text_sha256 FROM d, t
"""


@query
def op10_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), vocabulary())


@query
def op11_manifest(spark, sf_dir):
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return merkle.manifest(documents(spark, sf_dir), odd, F.replace("text", F.lit("\n"), F.lit("")))


def _manifest_sql() -> str:
    """op11 in another engine: levels as a recursion over nodes, folding as one over a row's path."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(text if c == "text" else c) for c in merkle.FIELDS) + ")"
    grow = lambda name, start: f"""{name}(tree, lvl, i, n, h) AS (  # noqa: E731
    {start}
    UNION ALL
    SELECT tree, lvl + 1, i // {merkle.FANOUT}, (n + {merkle.FANOUT - 1}) // {merkle.FANOUT}, sha256(string_agg(h, '' ORDER BY i))
    FROM {name} WHERE n > 1 GROUP BY tree, lvl, n, i // {merkle.FANOUT})""".replace("  # noqa: E731", "")
    return rf"""
WITH RECURSIVE
crc(t) AS (SELECT list(c ORDER BY b) FROM (SELECT b, list_reduce(list_concat([b], range(8)),
               lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS b))),
d AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n,
             xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                                         lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]))) & 1 AS odd FROM documents, crc),
o AS (SELECT source AS name, (row_number() OVER (ORDER BY source NULLS FIRST) - 1) AS tree FROM (SELECT DISTINCT source FROM documents)),
l AS (SELECT doc_id, tree, i, n, {leaf("text")} AS h, CASE WHEN odd = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS g
      FROM d JOIN o ON source IS NOT DISTINCT FROM name),
{grow("a", "SELECT tree, 0::BIGINT, i, n, h FROM l")},
sub AS (SELECT tree, h FROM a WHERE n = 1),
{grow("b", "SELECT 0::BIGINT, 0::BIGINT, tree, count(*) OVER (), h FROM sub")},
y AS (SELECT * FROM a WHERE n > 1 UNION ALL SELECT s.tree, b.lvl + 1000, b.i, b.n, b.h FROM b JOIN sub s ON b.n > 1
      AND b.i // {merkle.FANOUT} = s.tree // pow({merkle.FANOUT}, b.lvl + 1)::BIGINT),
p AS (SELECT l.doc_id, y.lvl, CASE WHEN y.lvl < 1000 THEN l.i // pow({merkle.FANOUT}, y.lvl)::BIGINT
                                   ELSE l.tree // pow({merkle.FANOUT}, y.lvl - 1000)::BIGINT END AS own, y.i, y.h
      FROM l JOIN y ON l.tree = y.tree AND (y.lvl >= 1000 OR y.i // {merkle.FANOUT} = l.i // pow({merkle.FANOUT}, y.lvl + 1)::BIGINT)),
s AS (SELECT doc_id, lvl, coalesce(string_agg(h, '' ORDER BY i) FILTER (i < own), '') AS before,
             coalesce(string_agg(h, '' ORDER BY i) FILTER (i > own), '') AS after, row_number() OVER (PARTITION BY doc_id ORDER BY lvl) AS k
      FROM p GROUP BY doc_id, lvl),
f(doc_id, k, h) AS (SELECT doc_id, 0::BIGINT, g FROM l UNION ALL SELECT f.doc_id, s.k, sha256(before || f.h || after) FROM f JOIN s ON s.doc_id = f.doc_id AND s.k = f.k + 1),
folded AS (SELECT doc_id, arg_max(h, k) AS folded_root FROM f GROUP BY doc_id),
proof AS (SELECT doc_id, sha256(string_agg(before || after, '' ORDER BY k)) AS proof FROM s GROUP BY doc_id)
SELECT l.doc_id, l.h AS leaf, sub.h AS subroot, r.h AS root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = r.h AS verified
FROM l JOIN sub USING (tree) JOIN folded USING (doc_id) LEFT JOIN proof USING (doc_id) CROSS JOIN (SELECT h FROM b WHERE n = 1) r
"""


ORACLE["op11_manifest"] = _manifest_sql()


@query
def op12_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


@query
def op13_token_alignment(spark, sf_dir):
    return token_alignment.align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
