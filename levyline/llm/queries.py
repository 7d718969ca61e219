"""The registered queries opN_<name> and ``pipeline``, and the oracle SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .collocations import collocations
from .common import table
from .context_pii import PATTERNS, find
from .context_pii import shown as shown_spans
from .crossparse import identify
from .harmonic_pack import pack
from .hyper_shard import shuffle
from .lsh_forest import near_duplicates
from .pairwise_quality import rank, train
from .permutation_index import nearest
from .role_repair import damage, repair
from .template_decontam import leaks
from .url_filter import RULES, host_path, judge
from .winnow import edited_pairs, hashes, likeness, shown
from .warc import assemble, read_archives, resolve, write_archives


def op9_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op5_crossparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op7_harmonic_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op1_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rank(docs, train(docs, table(spark, sf_dir, "labels")))


def op2_template_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = edited_pairs(table(spark, sf_dir, "documents"))
    names = ("fingerprint", "edited_fingerprint", "next_fingerprint")
    rows = rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        *names[:2],
        *(hashes(F.col(c)).alias(f"{c}_set") for c in names),
    )
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        shown(F.col("fingerprint")).alias("fingerprint"),
        shown(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness("fingerprint_set", "edited_fingerprint_set").alias("near_edited"),
        likeness("fingerprint_set", "next_fingerprint_set").alias("near_next"),
    )


def op4_hyper_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shuffle(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return judge(table(spark, sf_dir, "pages"), rules)


def op8_context_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", *(count(k) for k in PATTERNS), F.sha2(shown_spans("base"), 256).alias("base_sha256"), shown_spans("spans").alias("spans"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(table(spark, sf_dir, "pages"))
    captures = assemble(read_archives(spark, manifest, with_payload=False))
    rows = resolve(captures)
    return rows.select(F.col("value").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op11_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op12_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair(damage(rows), of=rows)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_pairwise_quality": op1_pairwise_quality,
    "op2_template_decontam": op2_template_decontam,
    "op3_winnow": op3_winnow,
    "op4_hyper_shard": op4_hyper_shard,
    "op5_crossparse": op5_crossparse,
    "op6_url_filter": op6_url_filter,
    "op7_harmonic_pack": op7_harmonic_pack,
    "op8_context_pii": op8_context_pii,
    "op9_lsh_forest": op9_lsh_forest,
    "op10_warc": op10_warc,
    "op11_permutation_index": op11_permutation_index,
    "op12_role_repair": op12_role_repair,
    "op13_collocations": op13_collocations,
}
ORACLE: dict[str, str] = {
    "op6_url_filter": r"""
WITH u AS (
    SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS pos FROM pages
), r AS (
    SELECT page_id, CASE WHEN pos > 0 THEN substr(url, pos + 3) ELSE '' END AS rest FROM u
), h AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM r
), j AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
    END AS rule FROM h
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM j
""",
    "op9_lsh_forest": r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
    FROM documents
), s AS (
    SELECT doc_id, CASE
        WHEN len(ws) = 0 THEN []
        WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))))
    END AS sh FROM w
), c AS (
    SELECT min(doc_id) AS id, sh, md5(array_to_string(sh, chr(10))) AS k, len(sh) AS n FROM s WHERE len(sh) > 0 GROUP BY sh
), x AS (
    SELECT id, n, unnest(sh) AS t FROM c
), l AS (
    SELECT a.id AS a, b.id AS b FROM x a JOIN x b ON a.t = b.t AND a.id < b.id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), e AS (
    SELECT a, b FROM l UNION SELECT b, a FROM l
), r AS (
    SELECT id AS node, id AS root FROM c
    UNION
    SELECT e.b, r.root FROM r JOIN e ON e.a = r.node
), m AS (
    SELECT c.k, min(r.root) AS root FROM r JOIN c ON c.id = r.node GROUP BY c.k
)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, coalesce(m.root, s.doc_id) AS component_id, coalesce(m.root, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN m ON m.k = md5(array_to_string(s.sh, chr(10))) AND len(s.sh) > 0
""",
    "op10_warc": r"""
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS leader FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> leader THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> leader THEN leader END AS refers_to
FROM f
""",
    "op13_collocations": r"""
WITH RECURSIVE p AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), w AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p
), g AS (
    SELECT lang, len(s) AS k, s, count(*) AS f
    FROM (SELECT lang, unnest(flatten(list_transform([1, 2, 3, 4], lambda k: list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])))) AS s FROM w)
    GROUP BY lang, s
), n AS (
    SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang
), c AS (
    SELECT * FROM g WHERE k > 1 AND f >= 30
), cuts AS (
    SELECT c.lang, c.s, c.k, c.f AS a, unnest(range(1, c.k)) AS cut FROM c
), scored AS (
    SELECT x.lang, x.s, x.a, x.cut, l.f AS l, r.f AS r, ((2000000::HUGEINT * x.a) // (l.f::HUGEINT + r.f))::BIGINT AS score
    FROM cuts x JOIN g l ON l.lang = x.lang AND l.s = x.s[1:x.cut] JOIN g r ON r.lang = x.lang AND r.s = x.s[x.cut + 1:x.k]
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, cut) = 1
), inner_ AS (
    SELECT lang, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda i: s[i:i + m - 1])))) AS s, f FROM c
), longer AS (
    SELECT lang, s, max(f) AS f FROM inner_ GROUP BY lang, s
), kept AS (
    SELECT b.lang, array_to_string(b.s, ' ') AS phrase, b.a, b.l, b.r, b.score
    FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.s = b.s
    WHERE o.f IS NULL OR 100 * o.f::HUGEINT < 80 * b.a::HUGEINT
)
SELECT kept.lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept) kept JOIN n ON n.lang = kept.lang
WHERE rank <= 2000
""",
    "op12_role_repair": r"""
WITH RECURSIVE src AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
    FROM conversations
), kinds AS (
    SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)),
        lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
            lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295::BIGINT) % 20 AS kind
    FROM src
), damaged AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM kinds
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role)::VARCHAR || ':' || role || text), copy) AS i FROM damaged
), faults AS (
    SELECT conv_id, turn, role, text, i, substr(role, 1, 1) AS initial, CASE
        WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
        WHEN right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) NOT IN ('.', '!', '?') THEN 'truncated'
        ELSE '' END AS fault,
        lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM placed
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
    FROM faults GROUP BY conv_id
), path AS (
    SELECT conv_id, 0::BIGINT AS i, {c: 0::BIGINT, a: '', t: []::VARCHAR[]} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[]) AS s1,
           NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[]) AS s2, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[]) AS s3
    FROM counts
    UNION ALL
    SELECT conv_id, i,
        {c: z0.c + 3, a: z0.a || 'D', t: z0.t},
        list_min([CASE WHEN z1 IS NOT NULL THEN {c: z1.c + 3, a: z1.a || 'D', t: z1.t} END,
                  CASE WHEN free AND initial = 's' THEN {c: z0.c + more, a: z0.a || 'K', t: list_append(z0.t, kept)} END]),
        list_min(list_concat([CASE WHEN z2 IS NOT NULL THEN {c: z2.c + 3, a: z2.a || 'D', t: z2.t} END],
            list_concat(list_transform(list_filter([z0, z1, z3], lambda z: z IS NOT NULL AND free AND initial = 'u'), lambda z: {c: z.c + more, a: z.a || 'K', t: list_append(z.t, kept)}),
                        list_transform(list_filter([z0, z1, z3], lambda z: z IS NOT NULL AND free), lambda z: {c: z.c + more + 2, a: z.a || 'R', t: list_append(z.t, 'user:' || text)})))),
        list_min(list_concat([CASE WHEN z3 IS NOT NULL THEN {c: z3.c + 3, a: z3.a || 'D', t: z3.t} END],
            list_concat(list_transform(list_filter([z2], lambda z: z IS NOT NULL AND free AND initial = 'a'), lambda z: {c: z.c + more, a: z.a || 'K', t: list_append(z.t, kept)}),
                        list_transform(list_filter([z2], lambda z: z IS NOT NULL AND free), lambda z: {c: z.c + more + 2, a: z.a || 'R', t: list_append(z.t, 'assistant:' || text)}))))
    FROM (
        SELECT *, list_min([s3, {c: z2.c + 2, a: z2.a || 'I', t: list_append(z2.t, 'assistant:')}]) AS z3
        FROM (
            SELECT p.conv_id, f.i, f.initial, f.text, f.role || ':' || f.text AS kept, f.fault IN ('', 'truncated') AS free, CASE f.fault WHEN 'truncated' THEN 1 ELSE 0 END AS more,
                   s0 AS z0, s1 AS z1, s3,
                   list_min(list_prepend(s2, list_transform(list_filter([s0, s1, s3], lambda z: z IS NOT NULL), lambda z: {c: z.c + 2, a: z.a || 'I', t: list_append(z.t, 'user:')}))) AS z2
            FROM path p JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
        )
    )
), ended AS (
    SELECT p.conv_id, list_min([s0, s3, CASE WHEN z2 IS NOT NULL THEN {c: z2.c + 2, a: z2.a || 'I', t: list_append(z2.t, 'assistant:')} END]) AS best
    FROM (
        SELECT *, list_min(list_prepend(s2, list_transform(list_filter([s0, s1, s3], lambda z: z IS NOT NULL), lambda z: {c: z.c + 2, a: z.a || 'I', t: list_append(z.t, 'user:')}))) AS z2 FROM path
    ) p JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.i
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(array_to_string(coalesce(best.t, []), chr(10))) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
""",
}
