"""Registered queries over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.llm.common import prepare, read_table
from eddyline.session import fresh_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op1_token_counts")
def token_counts(spark, sf_dir):
    from eddyline.llm.token_counts import count_tokens

    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    counted = count_tokens(docs, vocabulary(BYTE_BPE), fresh_folder(spark, "token-cache"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


LINE_DEDUP_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS place
  FROM documents
), keyed AS (
  SELECT doc_id, place, line,
         translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE keeper IS NOT NULL AND doc_id <> keeper) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE keeper IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key) GROUP BY doc_id
"""


@query("op2_line_dedup", LINE_DEDUP_SQL)
def line_dedup(spark, sf_dir):
    from eddyline.llm.line_dedup import LineIndex

    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    index = LineIndex(spark, fresh_folder(spark, "line-index"))
    index.insert(docs)
    return index.dedupe(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op3_sentencepiece")
def sentencepiece(spark, sf_dir):
    return piece_digests(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def piece_digests(docs: DataFrame) -> DataFrame:
    """Per document: how many pieces, their hash, and whether they decode to the text."""
    from eddyline.llm.piece_codec import decode_pieces, encode_pieces

    path = vocabulary(PIECE_BPE)
    # The text's digest goes on to the decoder, not the text, which both would hold otherwise.
    encoded = encode_pieces(docs, path).select(
        "doc_id", F.sha2("text", 256).alias("text_sha256"), "ids", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("pieces_hash"),
    )
    return decode_pieces(encoded, path).select(
        "doc_id", "n_pieces", "pieces_hash", F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("lossless"),
    )


@query("op4_toxicity")
def toxicity(spark, sf_dir):
    from eddyline.llm.toxicity import score_toxicity

    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return score_toxicity(docs, read_table(spark, sf_dir, "labels"))


@query("op5_quality")
def quality(spark, sf_dir):
    from eddyline.llm.fm_quality import held_out, score_quality

    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    scored = score_quality(docs, read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(), "score", "predicted")


@query("op6_simhash")
def simhash(spark, sf_dir):
    from eddyline.llm.simhash import hex_mark, near_duplicates

    found = near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", hex_mark().alias("fingerprint"), "component_id")


@query("op7_edit_fingerprints")
def edit_fingerprints(spark, sf_dir):
    from eddyline.llm.edit_embedding import compare_with_next

    return compare_with_next(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def derived_captures(pages: DataFrame) -> DataFrame:
    """Captures by rule from ``pages``: each page is fetched, half are fetched again with
    a new body, all are asked for later under another spelling of their address and
    answer 304 (a quarter with an outdated tag, one without a tag), and some of those
    answers come before any response."""
    p, start = F.col("page_id"), F.lit(1_600_000_000) + F.col("page_id") % 5000 * 3600
    tag = lambda body: F.concat(F.lit('"'), F.md5(body), F.lit('"'))
    html = F.coalesce("html", F.lit(""))
    first, second = tag(html), tag(F.concat(html, F.lit("v2")))
    modified = F.concat(F.lit("day "), p % 13)
    other = F.concat(F.regexp_replace(F.regexp_replace("url", "#.*$", ""), "^https:", "HTTP:"), F.lit("#again"))

    def capture(place, kind, status, url, after, etag, changed, length):
        pairs = [("etag", etag), ("last-modified", changed), ("content-length", length), ("date", (start + after).cast("string"))]
        if kind == "response":
            pairs.append(("content-type", F.lit("text/html")))
        entries = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs]), lambda e: e["value"].isNotNull())
        return F.struct(
            (p * 10 + place).alias("record_id"), F.lit(kind).alias("warc_type"), F.lit(status).alias("status"),
            url.alias("url"), (start + after).alias("ts"), F.map_from_entries(entries).alias("headers"),
        )

    length = F.length(html).cast("string")
    asked = F.when(p % 4 == 0, F.lit('"old"')).when(p % 4 == 1, F.concat(F.lit("W/"), first)).when(p % 4 == 2, second)
    captures = F.array(
        capture(0, "response", 200, F.col("url"), 0, first, modified, length),
        F.when(p % 2 == 0, capture(1, "response", 200, F.col("url"), 40_000, second, modified, length)),
        capture(2, "revisit", 304, other, 90_000, asked, F.when(p % 4 == 3, modified), F.lit("0")),
        F.when(p % 7 == 0, capture(3, "revisit", 304, other, -10, first, F.lit(None).cast("string"), F.lit("0"))),
    )
    return pages.select(F.explode(F.array_compact(captures)).alias("c")).select("c.*")


WARC_SQL = r"""
WITH base AS (
  SELECT page_id AS p, url, coalesce(html, '') AS html, 1600000000 + page_id % 5000 * 3600 AS s,
         regexp_replace(regexp_replace(url, '#.*$', ''), '^https:', 'HTTP:') || '#again' AS other,
         '"' || md5(coalesce(html, '')) || '"' AS e1, '"' || md5(coalesce(html, '') || 'v2') || '"' AS e2
  FROM pages
), captures AS (
  SELECT p * 10 AS record_id, true AS is_full, url, s AS ts, e1 AS etag, 'day ' || (p % 13) AS lm, length(html)::VARCHAR AS len FROM base
  UNION ALL SELECT p * 10 + 1, true, url, s + 40000, e2, 'day ' || (p % 13), length(html)::VARCHAR FROM base WHERE p % 2 = 0
  UNION ALL SELECT p * 10 + 2, false, other, s + 90000,
    CASE p % 4 WHEN 0 THEN '"old"' WHEN 1 THEN 'W/' || e1 WHEN 2 THEN e2 END,
    CASE WHEN p % 4 = 3 THEN 'day ' || (p % 13) END, '0' FROM base
  UNION ALL SELECT p * 10 + 3, false, other, s - 10, e1, NULL, '0' FROM base WHERE p % 7 = 0
), parts AS (
  SELECT *, regexp_replace(trim(url), '#.*$', '', 's') AS bare FROM captures
), cut AS (
  SELECT *,
    regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?@]*@)?([^/?]*)', 1, 's')), ':(80|443)?$', ''), '^www\d*\.', '') AS host,
    regexp_replace(regexp_extract(bare, '^[^:/?]+://[^/?]*([^?]*)', 1, 's'), '(\.html?)?/*$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(bare, '^[^?]*\?(.*)$', 1, 's'), '&'),
      lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS kept
  FROM parts
), keyed AS (
  SELECT *, CASE WHEN host <> '' THEN host || path || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS url_key
  FROM (SELECT * RENAME (len AS clen) FROM cut)
), pairs AS (
  SELECT r.record_id, r.url_key, r.ts, r.etag, r.lm, f.record_id AS original_id, f.etag AS oe, f.lm AS ol, f.clen AS oc,
         row_number() OVER (PARTITION BY r.record_id ORDER BY f.ts DESC NULLS LAST, f.record_id DESC) AS k
  FROM (SELECT * FROM keyed WHERE NOT is_full) r
  LEFT JOIN (SELECT * FROM keyed WHERE is_full) f ON r.url_key = f.url_key AND f.ts < r.ts
), judged AS (
  SELECT *, CASE WHEN original_id IS NULL THEN 'no_original'
    WHEN CASE WHEN etag IS NOT NULL THEN regexp_replace(etag, '^W/', '') = oe WHEN lm IS NOT NULL THEN lm = ol ELSE true END
    THEN 'resolved' ELSE 'stale' END AS outcome
  FROM pairs WHERE k = 1
)
SELECT record_id, url_key, ts, original_id, outcome,
  CASE WHEN outcome = 'resolved' THEN 'content-length=' || oc || ';content-type=text/html;date=' || ts || ';etag=' || coalesce(etag, oe)
    || ';last-modified=' || coalesce(lm, ol) END AS headers
FROM judged
"""


@query("op8_warc_revisits", WARC_SQL)
def warc_revisits(spark, sf_dir):
    from eddyline.llm.warc_revisits import resolve_revisits

    found = resolve_revisits(derived_captures(read_table(spark, sf_dir, "pages", "page_id", "url", "html")))
    entries = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.withColumn("headers", F.array_join(entries, ";"))


HOST_SQL = r"""
WITH located AS (
  SELECT page_id,
    CASE WHEN contains(coalesce(url, ''), '://') THEN translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN contains(coalesce(url, ''), '://') THEN regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') ELSE '' END AS path
  FROM pages
), outcome AS (
  SELECT host, 1 - quality AS bad FROM located
  JOIN (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) l
    ON l.doc_id = try_cast(regexp_extract(path, '/(\d{1,18})(\.html)?/?$', 1) AS BIGINT)
  WHERE host <> ''
), counted AS (
  SELECT host, count(*) AS n, sum(bad) AS bad, array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix
  FROM outcome GROUP BY host
), total AS (SELECT (coalesce(sum(bad), 0) + 0.5::DOUBLE) / (coalesce(sum(n), 0) + 1.0::DOUBLE) AS m FROM counted
), levels AS (
  SELECT 'suffix' AS level, suffix AS name, sum(n) AS n, sum(bad) AS bad FROM counted GROUP BY suffix
  UNION ALL SELECT 'domain', domain, sum(n), sum(bad) FROM counted GROUP BY domain
  UNION ALL SELECT 'host', host, n, bad FROM counted
), sums AS (
  SELECT level, sum(n)::DOUBLE AS n, sum(n * n)::DOUBLE AS nn, count(*) AS k, sum(n * (bad::DOUBLE / n - m) * (bad::DOUBLE / n - m)) AS scatter,
         any_value(m) AS m FROM levels, total GROUP BY level
), weights AS (
  SELECT level, CASE WHEN n - nn / n <= 0 THEN 100.0::DOUBLE
    WHEN (scatter - (k - 1) * m * (1 - m)) / (n - nn / n) <= m * (1 - m) / 101 THEN 100.0::DOUBLE
    ELSE greatest(1.0::DOUBLE, m * (1 - m) / ((scatter - (k - 1) * m * (1 - m)) / (n - nn / n)) - 1) END AS w FROM sums
), w AS (
  SELECT coalesce(max(w) FILTER (WHERE level = 'suffix'), 100.0::DOUBLE) AS ws, coalesce(max(w) FILTER (WHERE level = 'domain'), 100.0::DOUBLE) AS wd,
         coalesce(max(w) FILTER (WHERE level = 'host'), 100.0::DOUBLE) AS wh FROM weights
), hosts AS (
  SELECT DISTINCT host, array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix FROM located
), means AS (
  SELECT h.host, coalesce(c.n, 0) AS n, coalesce(c.bad, 0) AS bad, wh,
    (coalesce(d.bad, 0) + wd * (coalesce(s.bad, 0) + ws * m) / (coalesce(s.n, 0) + ws)) / (coalesce(d.n, 0) + wd) AS prior
  FROM hosts h CROSS JOIN total CROSS JOIN w
  LEFT JOIN (SELECT * FROM levels WHERE level = 'suffix') s ON s.name = h.suffix
  LEFT JOIN (SELECT * FROM levels WHERE level = 'domain') d ON d.name = h.domain
  LEFT JOIN counted c ON c.host = h.host
), beta AS (SELECT host, bad + wh * prior AS a, n - bad + wh * (1 - prior) AS b FROM means
), lower_bound AS (
  SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS lo FROM beta
), ruled AS (
  SELECT *, CASE
    WHEN ends_with('.' || host, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM located
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN lo > 0.3 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN lower_bound USING (host)
"""


@query("op9_host_reputation", HOST_SQL)
def host_reputation(spark, sf_dir):
    """A page's outcome is the quality label of the document its address ends with."""
    from eddyline.llm.host_reputation import host_of, judge, path_of

    pages = read_table(spark, sf_dir, "pages", "page_id", "url")
    labels = read_table(spark, sf_dir, "labels").filter("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    shown = F.regexp_extract(path_of(F.col("url")), r"/(\d{1,18})(\.html)?/?$", 1).try_cast("bigint")
    outcomes = pages.select(host_of(F.col("url")).alias("host"), shown.alias("doc_id")).join(labels, "doc_id").select(
        "host", (1 - F.col("quality")).alias("bad")
    )
    return judge(pages, outcomes)


DECONTAMINATION_SQL = r"""
WITH docs AS (
  SELECT doc_id, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM documents
), items AS (
  SELECT item_id, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM benchmark
), doc_grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM docs)
), item_grams AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM items WHERE w <> [''])
), sizes AS (SELECT item_id, count(*) AS n FROM item_grams GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS shared, any_value(n) AS item_shingles, count(*)::DOUBLE / any_value(n) AS containment
FROM doc_grams JOIN item_grams USING (g) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= ceil(any_value(n) * 0.8::DOUBLE - 1e-9)
"""


@query("op10_decontamination", DECONTAMINATION_SQL)
def decontamination(spark, sf_dir):
    from eddyline.llm.decontamination import leaks

    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return leaks(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))


TRIE_SQL = r"""
WITH own AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos,
         {'r': coalesce(role, ''), 't': coalesce(text, '')} AS turn
  FROM conversations WHERE conv_id IS NOT NULL
), lists AS (SELECT c, list(turn ORDER BY pos) AS l FROM own GROUP BY c
), crc_table AS (
  WITH RECURSIVE steps(i, k, v) AS (
    SELECT i, 0, i FROM range(256) t(i)
    UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8
  ) SELECT list(v ORDER BY i) AS crc FROM steps WHERE k = 8
), hashed AS (
  SELECT c, l, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda a, x: xor(a >> 8, crc[(xor(a, x) & 255) + 1])), 4294967295) % 9 AS h
  FROM lists, crc_table
), rebuilt AS (
  SELECT a.c, coalesce(b.l, [])[1:a.h] || a.l[a.h + 1:] AS l FROM hashed a LEFT JOIN lists b ON b.c = a.c - a.c % 5
), members AS (
  SELECT c, d, l[1:d] AS p, len(l) AS n FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM members GROUP BY p, d
), children AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
), worth AS (
  SELECT n.p, n.d, n.n_children IS NULL AS leaf,
         CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * strlen(n.p[d].t) END AS saved
  FROM (SELECT nodes.*, n_children FROM nodes LEFT JOIN children USING (p)) n
), sums AS (
  SELECT p[1:k] AS p, count(*) FILTER (WHERE leaf) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM worth) GROUP BY 1
)
SELECT n.conv_id, n.d::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums USING (p) LEFT JOIN children USING (p) LEFT JOIN nodes q ON n.d > 0 AND q.p = n.p[1:n.d - 1]
"""


@query("op11_conversation_trie", TRIE_SQL)
def conversation_trie(spark, sf_dir):
    from eddyline.llm.conversation_trie import ordered_turns, prefix_trie, regrafted

    turns = ordered_turns(read_table(spark, sf_dir, "conversations"))
    return prefix_trie(*regrafted(turns))


COLLOCATION_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces
), starts AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM w
), grams AS (SELECT lang, w[i : i + k - 1] AS g, k FROM (SELECT *, unnest(generate_series(1, least(5, len(w) - i + 1))) AS k FROM starts)
), freq AS (SELECT lang, array_to_string(g, ' ') AS phrase, any_value(g) AS g, any_value(k) AS k, count(*) AS f FROM grams GROUP BY lang, array_to_string(g, ' ') HAVING count(*) >= 100
), totals AS (SELECT lang, count(*) AS n FROM starts GROUP BY lang
), inside AS (
  SELECT DISTINCT lang, array_to_string(g[i : i + j - 1], ' ') AS phrase, f
  FROM (SELECT *, unnest(generate_series(1, k - j + 1)) AS i FROM (SELECT *, unnest(generate_series(2, k - 1)) AS j FROM freq WHERE k > 2))
), candidates AS (
  SELECT c.* FROM freq c WHERE k >= 2 AND NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.f >= 100 * c.f)
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, j, x.f AS l, y.f AS r, n, ((1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM candidates) c JOIN totals USING (lang)
  JOIN freq x ON x.lang = c.lang AND x.phrase = array_to_string(c.g[1:j], ' ')
  JOIN freq y ON y.lang = c.lang AND y.phrase = array_to_string(c.g[j + 1:], ' ')
), worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM worst QUALIFY rank <= 2000
"""


@query("op13_collocations", COLLOCATION_SQL)
def phrase_collocations(spark, sf_dir):
    from eddyline.llm.phrase_index import collocations

    return collocations(read_table(spark, sf_dir, "documents", "lang", "text"), least=100, top=2000)


VECTOR_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93::DOUBLE
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), lowest AS (SELECT a, min(b) AS low FROM reach GROUP BY a
), degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings e LEFT JOIN degree d ON d.a = e.vec_id LEFT JOIN lowest l ON l.a = e.vec_id
"""


@query("op12_multi_index", VECTOR_SQL)
def multi_index(spark, sf_dir):
    from eddyline.llm.multi_index import near_vectors

    return near_vectors(read_table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding"), least=0.93, recall=0.99)
