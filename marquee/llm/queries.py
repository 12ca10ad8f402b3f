"""Registered queries of this subpackage, each with its DuckDB SQL where one exists.

``QUERIES`` maps a key to ``(fn(spark, sf_dir) -> DataFrame, oracle_sql | None)``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.llm.common import read, remainder

QUERIES: dict[str, tuple] = {}

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


@query("op2_byte_bpe")
def op2_byte_bpe(spark, d):
    """Every whole text encoded and decoded with the multilingual 50k byte-level vocabulary."""
    import public_tokenizers

    from marquee.llm import bpe

    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    docs = read(spark, d, "documents").select("doc_id", "text")
    return bpe.digests(bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id"]), ["doc_id"])


OP6_SQL = """
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
windows AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM words)),
repeated AS (SELECT doc_id, i FROM windows
             QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n
            FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY doc_id),
lines AS (SELECT doc_id, source, md5(text) AS body, raw,
                 trim(regexp_replace(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS line
          FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS raw FROM d)),
dup AS (SELECT doc_id, count(*) - count(DISTINCT raw) AS n FROM lines WHERE line <> '' GROUP BY doc_id),
often AS (SELECT source, line FROM lines WHERE line <> '' GROUP BY source, line HAVING count(DISTINCT body) > 20),
gone AS (SELECT l.doc_id, sum(len(regexp_extract_all(l.line, '[^\\x20\\x09-\\x0D]+'))) AS n
         FROM lines l JOIN often o ON l.source IS NOT DISTINCT FROM o.source AND l.line = o.line GROUP BY l.doc_id),
counts AS (
  SELECT d.doc_id, len(w.ws) AS n_words,
         length(regexp_replace(d.text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
         length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         CAST(coalesce(gone.n, 0) AS BIGINT) AS removed_words
  FROM d JOIN words w USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)
  LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND removed_words <= 0.5 * n_words AS kept
FROM counts
"""


@query("op6_line_rules", OP6_SQL)
def op6_line_rules(spark, d):
    """Base counts and the line-frequency verdict of every document; host: its source."""
    from marquee.llm import line_rules

    return line_rules.judge(read(spark, d, "documents").select("doc_id", "source", "text")).drop("source")


# Words whose appearance as a part of a host name put a URL on the stand-in list.
SPAM_WORDS = ("casino", "porn", "poker", "viagra", "lottery", "betting")

OP8_SQL = """
WITH p AS (
  SELECT page_id, url, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         list_filter(string_split(regexp_extract(url, '(?s)^.*?://[^?#]*[?]([^#]*)', 1), '&'),
                     lambda x: x <> '' AND NOT starts_with(x, 'utm_')) AS params
  FROM pages),
c AS (
  SELECT *, CASE WHEN contains(url, '://') THEN
           regexp_replace(regexp_replace(host, '(:80|:443)$', ''), '[.]$', '') || regexp_replace(path, '/+$', '')
           || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canon
  FROM p),
listed AS (SELECT DISTINCT canon FROM c
           WHERE regexp_matches(host, '(^|[.-])(casino|porn|poker|viagra|lottery|betting)([.-]|$)')),
fit AS (
  SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/')
                   THEN 'example.net/en/'
                 WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/')
                   THEN 'example.com/de/'
                 WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                 WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM c)
SELECT page_id, host, path, rule, canon IS NOT NULL AND canon IN (SELECT canon FROM listed) AS listed,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN canon IN (SELECT canon FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM fit
"""


@query("op8_url_filter", OP8_SQL)
def op8_url_filter(spark, d):
    """Every page's URL against the rules and a list; stand-in list: URLs on hosts with a spam word."""
    from marquee.llm import url_filter

    pages = read(spark, d, "pages").select("page_id", "url")
    listed = pages.select("url").filter(
        url_filter.host_of(F.col("url")).rlike(r"(^|[.-])(" + "|".join(SPAM_WORDS) + r")([.-]|$)"))
    return url_filter.filter_urls(pages, listed).drop("url")


OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
x AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex,
             max(page_id) OVER (PARTITION BY html) AS newest FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || substr(hex, CAST((i // 4) * 5 + 1 AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31
              AS INT) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < newest THEN newest END AS refers_to
FROM x
"""


@query("op9_warc", OP9_SQL)
def op9_warc(spark, d):
    """Every page written to WARC archives and read back through the index."""
    from marquee.llm import warc

    folder, index = warc.write_archives(read(spark, d, "pages"))
    return warc.read_records(spark, folder, index).drop("url", "payload")


@query("op10_edit_fingerprint")
def op10_edit_fingerprint(spark, d):
    """Fingerprints of every text and of its edited text, with their likeness, and the class of
    near copies that banding over all texts finds."""
    from marquee.llm import edit_fingerprint

    return edit_fingerprint.with_near_classes(read(spark, d, "documents"))


@query("op3_language_id")
def op3_language_id(spark, d):
    """Language of every text, learned from a sample of rows with crc32(doc_id) mod 3 <> 1."""
    from marquee.llm import langid

    docs = read(spark, d, "documents")
    held_out = remainder(F.col("doc_id"), 3) == 1
    model = langid.fit(*langid.training_sample(docs.filter(~held_out), "lang"))
    return langid.identify(docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text"),
                           model, keep=["doc_id", "held_out"])


@query("op5_quality_cnn")
def op5_quality_cnn(spark, d):
    """Quality of every text, learned from a sample of labels with crc32(doc_id) mod 5 <> 0."""
    from marquee.llm import quality_cnn

    docs = read(spark, d, "documents")
    held_out = remainder(F.col("doc_id"), 5) == 0
    net = quality_cnn.learn(docs, read(spark, d, "labels").filter(~held_out))
    return quality_cnn.classify(docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text"),
                                net, keep=["doc_id", "held_out"])


@query("op4_html_template")
def op4_html_template(spark, d):
    """Main text of every page by the templates of its host."""
    from marquee.llm import html_template

    return html_template.main_text(read(spark, d, "pages"), keep=["page_id", "url"])


@query("op1_ngram_jaccard")
def op1_ngram_jaccard(spark, d):
    """Groups of documents linked by 5-word shingle sets with a Jaccard similarity of 0.75 or more,
    and the number of links of each document."""
    from marquee.llm import ngram_join

    return ngram_join.link_groups(read(spark, d, "documents").select("doc_id", "text"), count_links=True)


# Stand-in domains of the sources, and the weights of the mix.
DOMAINS = {"web": ("src0", "src1", "src2", "src3", "src4"), "news": ("src5", "src6", "src7", "src8", "src9"),
           "reference": ("src10", "src11", "src12", "src13", "src14"),
           "forum": ("src15", "src16", "src17", "src18", "src19")}
MIX_WEIGHTS = {"domain": {"web": 0.3, "news": 0.2, "reference": 0.3, "forum": 0.2},
               "lang": {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}}
MIX_FRACTION = 0.8


def domain_of(source):
    """Stand-in domain of a source column; ``other`` for any source not listed."""
    out = F.lit("other")
    for name, sources in DOMAINS.items():
        out = F.when(source.isin(*sources), name).otherwise(out)
    return out


def _split_sql(level: str, parents: str, child: str, above: str) -> str:
    """CTEs that split the budgets of ``above`` among the nodes of a level."""
    on = " AND ".join(f"n.{c} IS NOT DISTINCT FROM a.{c}" for c in parents.split(", ")) if parents else "TRUE"
    per = f"PARTITION BY {parents}" if parents else ""
    return f"""
{level}_in AS (SELECT n.*, a.budget, n.cap / n.w AS ratio FROM {level}_node n JOIN {above} a ON {on}),
{level}_lvl AS (SELECT *, (budget - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM {level}_in
    WINDOW o AS ({per} ORDER BY ratio, {child} NULLS FIRST)),
{level}_out AS (SELECT * EXCLUDE (budget), CASE WHEN ratio <= lvl THEN cap ELSE greatest(0.0, w * max(
    CASE WHEN ratio > lvl THEN lvl END) OVER ({per})) END AS budget FROM {level}_lvl)"""


def _weight_sql(level: str) -> str:
    cases = "".join(f" WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in MIX_WEIGHTS[level].items())
    return f"CASE {level}{cases} ELSE 1.0 END"


def mix_sql(documents: str, max_epochs: float) -> str:
    """DuckDB SQL of the mix over a table (doc_id, text, lang, source): (doc_id, domain, lang, source, n_tokens, epoch)."""
    domain = "CASE" + "".join(
        f" WHEN source IN ({', '.join(repr(s) for s in names)}) THEN '{d}'" for d, names in DOMAINS.items()) + " ELSE 'other' END"
    return f"""
WITH d AS (SELECT doc_id, lang, source, {domain} AS domain,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens FROM {documents}),
t AS (SELECT * FROM d WHERE n_tokens > 0),
leaf AS (SELECT domain, lang, source, sum(n_tokens) AS tokens, sum(n_tokens) * CAST({max_epochs} AS DOUBLE) AS cap,
                CAST(1 AS DOUBLE) AS w FROM t GROUP BY ALL),
root AS (SELECT sum(tokens) * CAST({MIX_FRACTION} AS DOUBLE) AS budget FROM leaf),
a_node AS (SELECT domain, sum(cap) AS cap, {_weight_sql("domain")} AS w FROM leaf GROUP BY domain),
b_node AS (SELECT domain, lang, sum(cap) AS cap, {_weight_sql("lang")} AS w FROM leaf GROUP BY domain, lang),
c_node AS (SELECT * FROM leaf),
{_split_sql("a", "", "domain", "root")},
{_split_sql("b", "domain", "lang", "a_out")},
{_split_sql("c", "domain, lang", "source", "b_out")},
cut AS (SELECT domain, lang, source, CAST(floor(budget / tokens) AS INT) AS whole,
               budget - floor(budget / tokens) * tokens AS wanted FROM c_out),
placed AS (SELECT t.*, whole, wanted, md5(concat('1:', whole, ':', doc_id)) AS place
           FROM t JOIN cut c ON t.domain = c.domain AND t.lang IS NOT DISTINCT FROM c.lang
                             AND t.source IS NOT DISTINCT FROM c.source),
summed AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto FROM placed)
SELECT doc_id, domain, lang, source, n_tokens,
       CAST(unnest(range(0, whole + CASE WHEN upto < wanted THEN 1 ELSE 0 END)) AS INT) AS epoch
FROM summed"""


@query("op7_source_mix", mix_sql("documents", 2.0))
def op7_source_mix(spark, d):
    """Documents of a mix of 80 % of all tokens by weights of domain, language and source, at most two epochs."""
    from marquee.llm import mixing

    docs = read(spark, d, "documents").withColumn("domain", domain_of(F.col("source")))
    return mixing.mix(docs, MIX_WEIGHTS, MIX_FRACTION, max_epochs=2.0).drop("text", "n_chars")


@query("op11_simhash")
def op11_simhash(spark, d):
    """64-bit SimHash of 3-word shingles of every text, and the groups linked by at most three differing bits."""
    from marquee.llm import simhash

    return simhash.near_groups(read(spark, d, "documents"))


@query("op12_token_links")
def op12_token_links(spark, d):
    """Tokens of two tokenizers aligned over every whole text, with corpus-wide counts of linked id pairs."""
    import public_tokenizers

    from marquee.llm import cross_tokens

    return cross_tokens.link_scores(read(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                    public_tokenizers.path("piece_bpe_32k.model"))


def kmeans_sql(rounds: int = 10) -> str:
    """DuckDB SQL of the clusters, one pair of CTEs per round; each vector is compared with every centroid."""
    def assigned(name, centroids):
        return f"""
{name} AS MATERIALIZED (
  SELECT k.pos, min(struct_pack(d := list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))),
                               c := c.c)) AS m
  FROM kept k, {centroids} c GROUP BY k.pos)"""

    parts = []
    for i in range(rounds):
        parts.append(assigned(f"a{i}", f"c{i}") + f""",
s{i} AS (SELECT a.m.c AS c, u.i, sum(k.v[u.i]) AS s, CAST(count(*) AS HUGEINT) AS n
         FROM a{i} a JOIN kept k USING (pos), (SELECT unnest(range(1, 65)) AS i) u GROUP BY a.m.c, u.i),
n{i} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{i} GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(n.v, o.v) AS v FROM c{i} o LEFT JOIN n{i} n ON o.c = n.c)""")
    body = ",".join(parts)
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS pos, vec_id,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, v FROM kept
                    WHERE vec_id IS NOT NULL ORDER BY sha256('3:' || vec_id) LIMIT 8),
{body},
{assigned("z", f"c{rounds}")}
SELECT k.vec_id, CAST(z.m.c AS INTEGER) AS cluster, CAST(z.m.d AS BIGINT) AS distance,
       CAST(sum(z.m.d) OVER (PARTITION BY z.m.c) AS BIGINT) AS cluster_inertia, CAST(sum(z.m.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM z JOIN kept k USING (pos) JOIN c{rounds} c ON c.c = z.m.c"""


@query("op13_centroids", kmeans_sql())
def op13_centroids(spark, d):
    """Eight clusters of all vectors by ten exact integer rounds."""
    from marquee.llm import shallot

    return shallot.clusters(read(spark, d, "embeddings"))
