"""One query for each operator of this folder, with the SQL that gives the same rows where SQL can express it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.llm import chat, decontaminate, fingerprint, jaccard, licenses, neardup, packing, quality, spelling, substring, toxicity, trie, warc
from fleetmart.operators.settle import settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: the unsigned CRC-32 of texts of characters below U+0100: a table of the byte values' CRCs, and a fold over UTF-8 bytes
CRC_TABLE = """r(i, k, v) AS (SELECT range, 0, range FROM range(256) UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM r WHERE k < 8),
    crc(tab) AS (SELECT list(v ORDER BY i) FROM r WHERE k = 8)"""


def crc_sql(text: str) -> str:
    """The CRC of a SQL text, in a query that has CRC_TABLE."""
    code = "unicode(c)"
    each = f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN {code} < 128 THEN [{code}::BIGINT] ELSE [192 + ({code} >> 6), 128 + ({code} & 63)]::BIGINT[] END))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {each}), lambda x, y: xor(x >> 8, tab[(xor(x, y) & 255) + 1])), 4294967295)"


def crc_fold(n: int):
    """The remainder that holds a document out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@query(
    "op1_decontaminate",
    rf"""
    WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{ALNUM}') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all({LOWER}, '{ALNUM}') AS w FROM benchmark),
    bw AS (
        SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
    lengths AS (SELECT DISTINCT k FROM bw),
    dw AS (
        SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, lengths WHERE len(w) >= k)),
    hits AS (SELECT doc_id, item_id, i, dw.k FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g),
    covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
    items AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY doc_id)
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark n-grams in all documents."""
    marks = decontaminate.mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return marks.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def toxic_lexicon(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Lexicon:
    """Learned from the labels whose fold is not 2."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(crc_fold(4) != 2)
    # texts are joined in one way at every size
    return toxicity.learn(docs.select("doc_id", "text").filter(crc_fold(4) != 2).join(labels.hint("merge"), "doc_id"))


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxic_lexicon(spark, docs, sf_dir))
    return scored.select("doc_id", (crc_fold(4) == 2).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query(
    "op7_near_duplicates",
    rf"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{SPACED}') AS w FROM documents),
    s AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    both_ways AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM both_ways JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
    reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a),
    found AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, component_id = d.doc_id AS kept
    FROM d LEFT JOIN n USING (doc_id) JOIN found USING (doc_id)
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents, on shingles of four words."""
    found = neardup.classes(table(spark, sf_dir, "documents"), size=4)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("component_id") == F.col("doc_id")).alias("kept"))


@query(
    "op8_substring_dedup",
    rf"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{SPACED}') AS w FROM documents),
    g AS (
        SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
    firsts AS (SELECT g, min(doc_id) AS f FROM g GROUP BY g),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN firsts USING (g) WHERE f < doc_id),
    lists AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
        sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE [w[i] FOR i IN range(1, len(w) + 1) IF NOT list_contains(ps, i)] END, ' ')) AS kept_sha256
    FROM d LEFT JOIN lists USING (doc_id)
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of windows that a smaller document has."""
    return substring.digests(table(spark, sf_dir, "documents"))


@query("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents")).withColumn("piece", F.col("piece").cast("int"))


CHAT_EXTRA = "</s>[INST] ok [/INST]"
_CONTROLS = "|".join(re.sub(r"([|\[\]])", r"\\\1", c[1:]) for c in chat.CONTROLS)


@query(
    "op2_chat_format",
    rf"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '{CHAT_EXTRA}' UNION ALL SELECT -7, 1, 'assistant', '{CHAT_EXTRA}'),
    t AS (
        SELECT conv_id, count(*) AS n_turns,
            string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
            coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
            sum(length(role) + length(regexp_replace(text, '([<\[])(\\*)({_CONTROLS})', '\1\2\\\3', 'g')) + {len(chat.START) + len(chat.END) + 2}) AS chars
        FROM c GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars
    FROM t
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that consists of control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CHAT_EXTRA), (-7, 1, "assistant", CHAT_EXTRA)], rows.schema)
    return chat.digests(chat.format(rows.union(extra))).drop("n_ids")


@query("op4_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labels whose fold is not 0."""
    rows = settle(quality.measured(table(spark, sf_dir, "documents")))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(crc_fold(5) != 0)
    model = quality.fit(rows.join(labels, "doc_id"))
    scored = quality.score(rows, model)
    return scored.select("doc_id", (crc_fold(5) == 0).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


_TEMPLATES = ", ".join(f"({n}, '{t.label}', {t.base}, string_split('{t.text}', ' '))" for n, t in enumerate(licenses.TEMPLATES))


@query(
    "op6_licenses",
    rf"""
    WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{ALNUM}') AS w FROM documents),
    t(template, label, base, w) AS (VALUES {_TEMPLATES}),
    tg AS (SELECT template, label, base, len(w) - 2 AS positions, i - 1 AS template_at, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM t)),
    dg AS (SELECT doc_id, i - 1 AS place, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
    hits AS (SELECT DISTINCT doc_id, template, label, base, positions, place - template_at AS diagonal, template_at FROM dg JOIN tg USING (g)),
    found AS (SELECT doc_id, template, label, base, positions, diagonal, count(*) AS votes FROM hits GROUP BY ALL),
    exact AS (
        SELECT doc_id, count(*) AS n, min(diagonal) AS a, max(diagonal) AS z, list_sort(list(DISTINCT label)) AS labels FROM found WHERE base AND votes = positions GROUP BY doc_id),
    spans AS (
        SELECT f.doc_id, f.label, f.base, count(DISTINCT h.template_at)::DOUBLE / any_value(f.positions) AS cover
        FROM found f JOIN hits h ON h.doc_id = f.doc_id AND h.template = f.template AND h.diagonal BETWEEN f.diagonal AND f.diagonal + {licenses.DRIFT}
        GROUP BY f.doc_id, f.template, f.label, f.base, f.diagonal),
    covered AS (SELECT doc_id, max(cover) AS score, list(DISTINCT label) FILTER (cover >= {licenses.COVER} AND NOT base) AS labels FROM spans GROUP BY doc_id)
    SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(exact.n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, z::BIGINT AS last_word,
        coalesce(array_to_string(exact.labels, ','), '') AS base_labels,
        coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(exact.labels, []), coalesce(covered.labels, [])))), ','), '') AS labels,
        coalesce(score, 0.0)::DOUBLE AS score
    FROM d LEFT JOIN exact USING (doc_id) LEFT JOIN covered USING (doc_id)
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License texts in all documents."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.withColumns({"base_labels": F.concat_ws(",", "base_labels"), "labels": F.concat_ws(",", "labels")})


@query("op9_fingerprints")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and their edited texts."""
    return fingerprint.edited(table(spark, sf_dir, "documents"))


@query(
    "op10_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
    f AS (SELECT html, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY html)
    SELECT page_id, n AS payload_bytes, sha256(html) AS payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN first < page_id THEN first END AS refers_to
    FROM p LEFT JOIN f USING (html)
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as compressed WARC archives, read back."""
    return warc.pages(spark, warc.archive(table(spark, sf_dir, "pages"), compression="gzip"))


@query(
    "op13_jaccard_join",
    rf"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{SPACED}') AS w FROM documents),
    s AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    both_ways AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM both_ways JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
    reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a),
    found AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id FROM d LEFT JOIN n USING (doc_id) JOIN found USING (doc_id)
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under links at a Jaccard similarity of 0.8, on shingles of five words."""
    return jaccard.join(table(spark, sf_dir, "documents"))


@query(
    "op12_prefix_trie",
    rf"""
    WITH RECURSIVE {CRC_TABLE},
    o AS (
        SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    h AS (SELECT conv_id, own, {crc_sql("conv_id::VARCHAR")} % 6 AS h FROM o, crc),
    c AS (SELECT h.conv_id AS c, list_concat(coalesce(o.own[1:h.h], []), h.own[h.h + 1:]) AS w FROM h LEFT JOIN o ON o.conv_id = h.conv_id - h.conv_id % 100),
    p AS (SELECT c, len(w) AS n, d, w[1:d] AS s FROM (SELECT c, w, unnest(range(0, len(w) + 1)) AS d FROM c)),
    n AS (
        SELECT d, s, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '') AS ends FROM p GROUP BY d, s),
    child AS (SELECT a.d, a.s, count(b.d) AS n_children FROM n a LEFT JOIN n b ON b.d = a.d + 1 AND b.s[1:a.d] = a.s GROUP BY a.d, a.s),
    m AS (SELECT n.*, n_children, CASE WHEN n.d > 0 THEN (n_convs - 1) * length(n.s[n.d].text) ELSE 0 END AS saved FROM n JOIN child USING (d, s))
    SELECT a.conv_id, a.d AS depth, any_value(p.conv_id) AS parent_conv_id, any_value(a.n_convs)::BIGINT AS n_convs, any_value(a.n_children)::BIGINT AS n_children,
        sum((b.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(b.saved)::BIGINT AS saved_tokens, sha256(any_value(a.ends)) AS ends_sha256
    FROM m a JOIN m b ON b.d >= a.d AND b.s[1:a.d] = a.s LEFT JOIN m p ON p.d = a.d - 1 AND p.s = a.s[1:a.d - 1]
    GROUP BY a.conv_id, a.d
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each branched off the first of its hundred."""
    return trie.nodes(*trie.rebuilt(trie.turns(table(spark, sf_dir, "conversations"))))


@query(
    "op11_spelling_variants",
    rf"""
    WITH RECURSIVE {CRC_TABLE},
    runs AS (SELECT doc_id, unnest(regexp_extract_all({LOWER}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
    counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
    hashed AS (SELECT run, n, {crc_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM counted, crc),
    spelled AS (SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed),
    v AS (SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    cut AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
    near AS (
        SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
        UNION SELECT cut.word, v.word, v.n FROM cut JOIN v ON v.word = rest
        UNION SELECT v.word, cut.word, cut.n FROM cut JOIN v ON v.word = rest),
    best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, encode(other)) AS other, max(n) AS most FROM near GROUP BY word),
    f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * v.n THEN other END AS form, CASE WHEN most >= 10 * v.n THEN most END AS form_n FROM v LEFT JOIN best USING (word)),
    chain(word, root, k) AS (SELECT word, word, 0 FROM f UNION ALL SELECT chain.word, f.form, k + 1 FROM chain JOIN f ON f.word = chain.root WHERE f.form IS NOT NULL),
    ends AS (SELECT word, arg_max(root, k) AS root FROM chain GROUP BY word)
    SELECT word, form, root, n, n_near, form_n FROM f JOIN ends USING (word)
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))
