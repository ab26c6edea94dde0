"""The training-data queries: ``fn(spark, sf_dir) -> DataFrame`` under ``op<N>_<name>``, with
DuckDB SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfscore.llm import (
    ann,
    collocations,
    exact_dedup,
    fill_middle,
    jaccard_join,
    line_dedup,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    token_store,
    url_filter,
)
from perfscore.llm.common import table
from perfscore.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query and, if SQL can express it, its oracle."""
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


_BOILER = " OR ".join(f"contains(lower(l), '{p}')" for p in quality_rules.LineRules().boilerplate)
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_COUNT = "len(regexp_extract_all(l, '{}'))"
_NUMBER = r"(length(l) - length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')) + 1)"
_CHARS = r"length(regexp_replace({}, '[\x20\x09-\x0D]+', '', 'g'))"
_END = r"""[.!?…:;。！？][\"''”’»)\]]*(?:[\x20\x09-\x0D]|$)"""

OP10_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, {_WORDS.format('t')} AS w FROM d),
win AS (SELECT rid, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g
        FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS p FROM w)),
rep AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n >= 2),
cov AS (SELECT rid, count(DISTINCT q) AS n_repeat_words
        FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM rep) GROUP BY rid),
ln AS (SELECT rid, generate_subscripts(ls, 1) AS k, unnest(ls) AS l
       FROM (SELECT rid, string_split(t, chr(10)) AS ls FROM d)),
judged AS (SELECT rid, k, l,
    (NOT regexp_matches(l, '{_END}') AND regexp_matches(l, '[^\x20\x09-\x0D]'))
    OR {_COUNT.format('[#*$%&|<>]')} > 0.3 * {_NUMBER}
    OR {_COUNT.format('[|»›•]')} > 0.15 * {_NUMBER}
    OR (regexp_matches(l, '\p{{Lu}}{{2}}') AND {_COUNT.format(chr(92) + 'p{Lu}')} > 0.6 * {_CHARS.format('l')})
    OR (length(l) <= 160 AND ({_BOILER})) AS fails FROM ln),
lines AS (SELECT rid, coalesce(sum({_CHARS.format('l')}) FILTER (NOT fails), 0) AS good_chars,
    count(*) FILTER (regexp_matches(l, '[^\x20\x09-\x0D]')) AS worded,
    count(DISTINCT l) FILTER (regexp_matches(l, '[^\x20\x09-\x0D]')) AS different FROM judged GROUP BY rid),
base AS (SELECT rid, doc_id, len(w) AS n_words, {_CHARS.format('t')} AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, worded - different AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, good_chars
    FROM d JOIN w USING (rid) JOIN lines USING (rid) LEFT JOIN cov USING (rid)),
b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM base)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
    (NOT base_failed AND word_chars - good_chars <= 0.5 * word_chars) AS kept
FROM b"""


@query("op10_quality_rules", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first cleaning of every whole text: base counts and verdict per document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.clean_lines(docs).select("doc_id", *quality_rules.BASE, "base_failed", "kept")


OP1_SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, coalesce(text, '') AS t FROM documents),
ln AS (SELECT doc_id, t, generate_subscripts(ls, 1) - 1 AS k, unnest(ls) AS l
       FROM (SELECT doc_id, t, string_split(t, chr(10)) AS ls FROM d)),
tok AS (SELECT doc_id, t, k, r, list_transform(r, lambda w: CASE WHEN regexp_matches(w, '\d') THEN '<*>' ELSE w END) AS w
        FROM (SELECT *, regexp_extract_all(l, '[^\x20\x09-\x0D]+') AS r FROM ln)),
lines AS (SELECT doc_id, t, k, r, w, [len(w)::VARCHAR] || w[1:3] AS leaf FROM tok WHERE len(w) > 0),
several AS (SELECT leaf FROM lines GROUP BY leaf HAVING count(DISTINCT w) > 1),
places AS (SELECT leaf, w, generate_subscripts(w, 1) AS p, unnest(w) AS x
           FROM (SELECT DISTINCT leaf, w FROM lines WHERE leaf IN (SELECT leaf FROM several))),
marked AS (SELECT leaf, w, p, x, count(*) OVER (PARTITION BY leaf, p, x) AS n FROM places WHERE x <> '<*>'),
support AS (SELECT leaf, w, list({'p': p, 'x': x, 'n': n} ORDER BY p) AS ts, list_sort(list(n) FILTER (WHERE p > 3)) AS s
            FROM marked GROUP BY leaf, w),
fixed AS (SELECT leaf, w, len(ts) AS words, list_filter(ts, lambda y: y.n > 1 AND 10 * y.n >= 7 * s[len(s) // 2 + 1]) AS f
          FROM support WHERE len(s) > 0),
known AS (SELECT leaf, w, list_transform(f, lambda y: [y.p::VARCHAR, y.x]) AS template FROM fixed
          WHERE len(f) >= 4 AND 10 * len(f) >= 7 * words AND 10 * len(f) >= 6 * len(w)),
templated AS (SELECT doc_id, t, k, leaf, coalesce(template, CASE WHEN 10 * len(list_filter(w, lambda y: y <> '<*>')) < 6 * len(w)
              THEN [['exact'], r] ELSE [w] END) AS template
              FROM lines LEFT JOIN known USING (leaf, w)),
texts AS (SELECT leaf, template, t, min(doc_id) AS first FROM templated GROUP BY ALL),
home AS (SELECT leaf, template, arg_min(t, first) AS home FROM texts GROUP BY leaf, template HAVING count(*) >= 2),
gone AS (SELECT doc_id, t, list(DISTINCT k::INTEGER ORDER BY k::INTEGER) AS dropped
         FROM templated JOIN home USING (leaf, template) WHERE t <> home GROUP BY doc_id, t),
marked_docs AS (SELECT d.doc_id, string_split(coalesce(d.text, ''), chr(10)) AS ls, coalesce(dropped, []) AS dropped, d.text
    FROM documents d LEFT JOIN gone ON d.doc_id IS NOT DISTINCT FROM gone.doc_id AND coalesce(d.text, '') = gone.t)
SELECT doc_id, len(ls)::BIGINT AS n_lines, len(dropped)::BIGINT AS n_dropped,
    array_to_string(list_transform(dropped, lambda x: x::VARCHAR), ',') AS dropped,
    CASE WHEN len(dropped) = 0 THEN length(coalesce(text, '')) ELSE
        length(array_to_string(list_filter(ls, lambda x, i: NOT list_contains(dropped, (i - 1)::INTEGER)), chr(10)))
    END::BIGINT AS clean_chars
FROM marked_docs"""


@query("op1_line_dedup", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Template-tree line dedup of every document: the lines that go, and what is left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_recurring_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped"),
        F.coalesce(F.length("clean_text"), F.lit(0)).cast("long").alias("clean_chars"))


@query("op4_sharding")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard (of 8) and slot by the weighted hash tree, and its shard of 9."""
    return sharding.shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best-two-fit packing of all documents' tokens into sequences of 2048."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op6_token_store")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' token ids, written as Re-Pair blocks and read back."""
    target = scratch_path(spark, "tokens")
    token_store.write_tokens(table(spark, sf_dir, "documents"), target)
    return token_store.read_tokens(spark, target)


@query("op7_mixing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pfair mix of all sources: every document's place in the schedule, once per epoch."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix_sources(docs).select("doc_id", "source", *mixing.PLACES)


OP8_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT r, array_to_string(w[p:p + 4], ' ') AS s
      FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.r <> b.r GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 10 * c >= 8 * (x.n + y.n - c)),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, class_id, n_links FROM d
JOIN (SELECT a AS r, min(doc_id) AS class_id FROM reach JOIN d ON d.r = reach.b GROUP BY a) USING (r)
JOIN (SELECT d.r, count(links.b)::BIGINT AS n_links FROM d LEFT JOIN links ON links.a = d.r GROUP BY d.r) USING (r)"""


@query("op8_jaccard_join", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate class and number of links (5 words, similarity 0.8)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.near_classes(docs).select("doc_id", "class_id", "n_links")


@query("op2_ann")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 vectors of the largest inner product with every 20th vector, by multiprobe hashing."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query("op3_quality_classifier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's quality score by the additive model."""
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.train_quality(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.score_quality(docs, model)


@query("op9_url_filter")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict, by the longest rule or else by the url model."""
    model = url_filter.train(url_filter.labelled_urls(spark))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, model).select("page_id", "host", "path", "rule", "verdict", "block_score")


OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
k AS (SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
      ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
      ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a,
      greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b FROM k),
p AS (SELECT *, array_to_string(w[1:a], '') AS p, array_to_string(w[a + 1:b], '') AS m, array_to_string(w[b + 1:n], '') AS s,
      CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR h3 % 100 >= 50 THEN 'plain'
           WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
           ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""


@query("op11_fill_middle", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document laid out for fill-in-the-middle, and rebuilt from that: digests of both."""
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output"), 256).alias("output_sha256"),
                       F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
k AS (SELECT r, doc_id, length(t) AS n, regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g') AS k FROM d),
p AS (SELECT *, first_value(doc_id) OVER best AS keep_id, row_number() OVER best AS place,
      count(*) OVER (PARTITION BY k) AS group_size
      FROM k WINDOW best AS (PARTITION BY k ORDER BY n DESC, doc_id NULLS LAST, r))
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, place = 1 AS kept, sha256(k) AS text_sha256 FROM p"""


@query("op12_exact_dedup", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of equal texts (white space aside) and the one that stays."""
    return exact_dedup.find_copies(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps
    FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(ps) AS p FROM d)),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
      GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, f AS a FROM f WHERE k > 1),
inner_ AS (SELECT lang, a AS longer, unnest(list_concat(
        CASE WHEN k = 3 THEN [ws[1:2], ws[2:3]] ELSE [ws[1:2], ws[2:3], ws[3:4], ws[1:3], ws[2:4]] END, [])) AS ws
      FROM c WHERE k > 2),
most AS (SELECT lang, array_to_string(ws, ' ') AS phrase, max(longer) AS longer FROM inner_ GROUP BY ALL),
own AS (SELECT c.* FROM c LEFT JOIN most USING (lang, phrase) WHERE coalesce(100::HUGEINT * longer < 80::HUGEINT * a, true)),
cut AS (SELECT lang, phrase, a, j, array_to_string(ws[1:j], ' ') AS p, array_to_string(ws[j + 1:], ' ') AS q
        FROM (SELECT *, unnest(range(1, k)) AS j FROM own)),
s AS (SELECT cut.*, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score FROM cut
      JOIN f x ON x.lang = cut.lang AND x.phrase = cut.p JOIN f y ON y.lang = cut.lang AND y.phrase = cut.q),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM low)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM r JOIN n USING (lang) WHERE rank <= 2000"""


@query("op13_collocations", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of 2 to 4 words, counted by stripes over all documents."""
    return collocations.mine_collocations(table(spark, sf_dir, "documents"))
