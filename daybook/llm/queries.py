"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.align import alignments
from daybook.llm.chat import collapsed
from daybook.llm.common import table
from daybook.llm.decontaminate import leaking_documents
from daybook.llm.embedding import near_vectors
from daybook.llm.language import held_out, train, with_language
from daybook.llm.mix import mixed
from daybook.llm.runs import without_runs
from daybook.llm.shard import shuffled_into_shards
from daybook.llm.simhash import simhash_groups
from daybook.llm.suffix_dedup import without_repeats
from daybook.llm.token_files import read_tokens, write_tokens
from daybook.llm.url_filter import judged, rules_of
from daybook.llm.warc import page_records, read_warc, write_warc
from daybook.workspace import scratch_folder

URL_ALLOW = ["com/", "www.example.com/en/"]
URL_BLOCK = ["example.com/en/", "net/es/", "net/fr/"]


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rules_of(spark, URL_ALLOW, URL_BLOCK)
    verdicts = judged(table(spark, sf_dir, "pages"), rules)
    return verdicts.select("page_id", "host", "path", "rule", "verdict")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths and digests of responses are taken from the payloads as read back, those of
    revisits, whose payload is not stored again, from their headers."""
    path = scratch_folder(spark, "warc")
    write_warc(page_records(table(spark, sf_dir, "pages")), path)
    page = lambda c: F.regexp_extract(c, r"\Aurn:page:(.+)\z", 1).try_cast("long")
    full = read_warc(spark, path, "record_id string, record_type string, payload binary")
    full = full.where("record_type = 'response'").select(
        page("record_id").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    heads = "record_id string, record_type string, payload_digest string, refers_to string, payload_length long"
    again = read_warc(spark, path, heads).where("record_type = 'revisit'").select(
        page("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )
    return full.union(again)


def op3_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    found = leaking_documents(documents, benchmark)
    numbers = [F.col(c).cast("long").alias(c) for c in ("start", "words", "matches")]
    return found.select("doc_id", "item_id", *numbers)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = train(documents.where(~held_out()))
    predicted = with_language(documents.select("doc_id", "text"), model)
    return predicted.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapsed(table(spark, sf_dir, "conversations"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=4, most=4)


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Besides the digest also ``text``, what is left; a character that was cut through is
    U+FFFD there."""
    cut = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=400)
    return cut.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("runs").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.expr("make_valid_utf8(CAST(kept AS STRING))").alias("text"),
    )


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
    )
    dealt = shuffled_into_shards(rows, shards=16)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixed(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source")


WORDS = r"[\x20\x09-\x0D]+"


def with_planted_periods(documents: DataFrame) -> DataFrame:
    """The texts that the contract sets: one in ten documents repeats, from a word on, the words
    from there to some words later until its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = documents.select("doc_id", "text", h.alias("h"), F.expr("CAST(crc32(CAST(doc_id AS STRING)) DIV 10 AS LONG)").alias("g"))
    words = F.when(F.col("h") % 10 == 0, F.filter(F.split("text", WORDS), lambda w: w != ""))
    rows = rows.withColumn("words", words).withColumn("n", F.size("words").cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) DIV (3 + g % 8)"))
    head = F.slice("words", F.lit(1), F.col("a").cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    period = F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), (F.col("n") - F.col("a")).cast("int"))
    planted = F.array_join(F.concat(head, tail), " ")
    return rows.select("doc_id", F.when(F.col("p").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat_ws("", F.transform(lines, lambda line: F.concat(line, F.lit("\n"))))
    longest = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")),
        )
    )
    found = found.withColumn("top", longest)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.s")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.p")).alias("period"),
        F.expr("1000 * top.length DIV -top.p").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_folder(spark, "tokens")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer, end_id=2)
    files = read_tokens(spark, path, "key long, start long, n_tokens long, id_bytes binary")
    return files.select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("id_bytes").alias("ids_crc32"))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = alignments(table(spark, sf_dir, "documents").select("doc_id", "text"), a, b, digest="sha2(groups, 256)")
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256")
    )


QUERIES = {
    "op1_urls": op1_urls,
    "op2_warc": op2_warc,
    "op3_leaks": op3_leaks,
    "op4_language": op4_language,
    "op5_chat": op5_chat,
    "op6_simhash": op6_simhash,
    "op7_repeats": op7_repeats,
    "op8_shards": op8_shards,
    "op9_vectors": op9_vectors,
    "op10_mix": op10_mix,
    "op11_runs": op11_runs,
    "op12_tokens": op12_tokens,
    "op13_align": op13_align,
}

ORACLE_SQL = {
    # pages with a canonical link to an absolute url, any order of its attributes
    "op1_urls": r"""
        WITH RECURSIVE rules(rule, action, host, path) AS (VALUES
            ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
            ('www.example.com/en/', 'allow', 'www.example.com', '/en/'),
            ('net/es/', 'block', 'net', '/es/'), ('net/fr/', 'block', 'net', '/fr/')),
        raw AS (
            SELECT page_id, url, regexp_extract(html, '(?is)<link\b[^>]*\brel=["'']?canonical\b[^>]*>') AS tag
            FROM pages),
        links AS (
            SELECT regexp_replace(url, '#.*', '') AS a,
                   regexp_extract(tag, '(?is)\bhref=["'']?(https?://[^"''\s>#]*)', 1) AS b
            FROM raw WHERE tag <> ''),
        edges AS (
            SELECT a, b FROM links WHERE b <> '' UNION SELECT b, a FROM links WHERE b <> ''),
        urls AS (
            SELECT DISTINCT url FROM pages UNION SELECT a FROM edges UNION SELECT b FROM edges),
        parts AS (
            SELECT url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM urls),
        fits AS (
            SELECT p.url, r.rule, r.action, row_number() OVER (
                       PARTITION BY p.url ORDER BY length(r.rule) DESC, r.action) AS nth
            FROM parts p JOIN rules r
              ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)),
        reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
        blocked AS (
            SELECT DISTINCT r.a FROM reach r JOIN fits f ON f.nth = 1 AND f.action = 'block'
              AND regexp_replace(f.url, '#.*', '') = r.b)
        SELECT g.page_id, p.host, p.path, f.rule,
               coalesce(f.action, CASE WHEN b.a IS NOT NULL THEN 'block' END, 'allow') AS verdict
        FROM pages g JOIN parts p ON g.url IS NOT DISTINCT FROM p.url
        LEFT JOIN fits f ON f.url = g.url AND f.nth = 1
        LEFT JOIN blocked b ON b.a = regexp_replace(g.url, '#.*', '')""",
    "op2_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        k AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
        f AS (SELECT *, CASE WHEN payload_bytes >= 1000
                        THEN max(page_id) OVER (PARTITION BY payload_digest) END AS first FROM k)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM f""",
    # every word of an item against every equal word of a document, counted along diagonals
    "op3_leaks": r"""
        WITH d AS (
            SELECT doc_id, list_filter(
                regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
        i AS (
            SELECT item_id, list_filter(
                regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
        dw AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d),
        iw AS (
            SELECT item_id, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS k
            FROM i WHERE len(w) >= 8),
        m AS (SELECT doc_id, item_id, n, pos - k AS start, k FROM dw JOIN iw USING (word)),
        often AS (SELECT doc_id, item_id, start FROM m GROUP BY ALL HAVING count(*) >= 7),
        s AS (
            SELECT *, count(*) OVER (
                PARTITION BY doc_id, item_id, start ORDER BY k
                RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS near
            FROM m SEMI JOIN often USING (doc_id, item_id, start)),
        f AS (
            SELECT doc_id, item_id, start, n AS words, count(*) AS matches
            FROM s GROUP BY ALL HAVING max(near) >= ceil(0.8 * least(13, n)))
        SELECT doc_id, item_id, start, words, matches FROM f
        QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matches DESC, start) = 1""",
    "op9_vectors": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        l AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
              ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
        r(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        c AS (SELECT a, min(b) AS least FROM r GROUP BY a),
        n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
        SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.least, vec_id) AS component_id,
               vec_id = coalesce(c.least, vec_id) AS kept
        FROM embeddings LEFT JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id""",
    "op5_chat": """
        WITH t AS (
            SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
        n AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                       role NULLS FIRST, text NULLS FIRST) - 1 AS place FROM t),
        p AS (
            SELECT *, list({'role': role, 'text': text}) OVER (
                       PARTITION BY conv_id ORDER BY place) AS prefix FROM n),
        e AS (SELECT conv_id, max(place) AS place, arg_max(prefix, place) AS prefix FROM p GROUP BY 1),
        u AS (SELECT min(conv_id) AS conv_id, prefix FROM e GROUP BY prefix),
        inside AS (SELECT DISTINCT p.prefix FROM p JOIN e USING (conv_id) WHERE p.place < e.place),
        kept AS (SELECT conv_id FROM u ANTI JOIN inside USING (prefix))
        SELECT conv_id, place, role,
               '<|' || coalesce(role, '') || '|>\n' || coalesce(text, '') || '<|end|>\n' AS rendered
        FROM n SEMI JOIN kept USING (conv_id)""".replace("\\n", "\n"),
}
