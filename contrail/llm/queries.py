"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import bpe, cws, langid, packing, quality, repair, secrets, simhash, tokenfile, toxicity, trie, urlfilter, warc
from contrail.llm.common import read_table, stash
from contrail.session import scratch_dir


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan every document as the one version of its path, with a ledger of its own."""
    ledger = scratch_dir(spark, "secret-ledger")
    index = secrets.scan(read_table(spark, sf_dir, "documents"), ["doc_id"], ledger)
    found = secrets.by_path(index, secrets.findings(spark, ledger))

    def of(*rules: secrets.Rule):
        return F.filter("spans", lambda s: s["rule"].isin(*[r.id for r in rules]))
    counts = [F.size(of(r)).cast("bigint").alias(f"n_{r.kind}") for r in secrets.BASE_RULES]
    return found.select("doc_id", *counts, F.sha2(secrets.as_text(of(*secrets.BASE_RULES)), 256).alias("base_sha256"),
                        secrets.as_text(F.col("spans")).alias("spans"), F.col("blob").alias("blob_sha256"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics of every document, and the verdict of the base rules and the learned list."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    marked = quality.statistics(docs, ["doc_id"]).select("doc_id", *counts, quality.base_failed().alias("base_failed"),
                                                         quality.deciding_rule(rules).alias("rule"))
    return marked.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_components(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op4_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """Encode every document with a public vocabulary, then decode the ids again."""
    tokens = bpe.load_ranks(public_tokenizers.path(vocabulary))
    tokenizer = bpe.Tokenizer(spark, tokens, public_tokenizers.PATTERN)
    ids = read_table(spark, sf_dir, "documents").select("doc_id", tokenizer.encode(F.col("text")).alias("ids"))
    both = ids.select("doc_id", "ids", tokenizer.decode(F.col("ids")).alias("decoded"))
    return both.select("doc_id", bpe.n_tokens(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page to archives and read them all back through the index."""
    root = scratch_dir(spark, "warc")
    index = warc.write(read_table(spark, sf_dir, "pages"), root)
    return warc.read(index, root, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries that follow from the pages: a fixed history for hosts, by their smallest page_id.

    Hosts named for betting, casinos or adult content, and one in five of the others, are listed on a day
    of 2024, some taken off again, some put back; every domain is listed for a week.
    """
    hosts = (pages.select(urlfilter.host_of(F.col("url")).alias("host"), "page_id").filter("host <> ''")
             .groupBy("host").agg(F.min("page_id").alias("n")))
    kind = F.when(F.col("host").rlike("adult|casino|bet"), F.lit("unwanted")).when(F.col("n") % 5 == 0, F.lit("reported"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n") % 200).cast("int"))
    events = F.array(
        F.struct(F.lit("add").alias("action"), F.lit(0).alias("after")),
        F.when(F.col("n") % 3 != 0, F.struct(F.lit("remove").alias("action"), (F.col("n") % 60 + 30).cast("int").alias("after"))),
        F.when(F.col("n") % 4 == 0, F.struct(F.lit("add").alias("action"), F.lit(120).alias("after"))))
    by_host = (hosts.select("host", kind.alias("category"), day.alias("day"), F.explode(events).alias("e"))
               .filter("category is not null and e is not null")
               .select(F.col("host").alias("domain"), "category", "e.action", F.date_add("day", F.col("e.after")).alias("day")))
    wide = (hosts.select(F.substring_index("host", ".", -2).alias("domain"), "n").groupBy("domain").agg(F.min("n").alias("n"))
            .select("domain", F.lit("outage").alias("category"), F.explode(F.array(F.lit("add"), F.lit("remove"))).alias("action"), day.alias("day"))
            .withColumn("day", F.when(F.col("action") == "add", F.col("day")).otherwise(F.date_add("day", 7))))
    return by_host.unionByName(wide)


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, fetched on a day that follows from its id, against the list as of that day."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 37 % 365).cast("int")))
    found = urlfilter.evaluate(captures, urlfilter.intervals(list_entries(pages)), ["page_id", "fetched"])
    return found.withColumns({c: F.col(c).cast("string") for c in ("fetched", "valid_from")})


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.compare_edited(read_table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack every document into sequences of 512 to 8192 words."""
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page, with a text model fitted on documents of known language."""
    model = langid.fit_text(read_table(spark, sf_dir, "documents"))
    html, url = F.col("html"), F.col("url")
    records = read_table(spark, sf_dir, "pages").select(
        "page_id", langid.text_scores(html, model, markup=True).alias("text_ll"), langid.declared_of(html).alias("declared"),
        langid.suffix_of(url).alias("suffix"), urlfilter.host_of(url).alias("host"))
    records = stash(records.withColumn("domain", langid.domain_of(F.col("host"))), "page-evidence")
    found = langid.identify(records, model.langs)
    return found.select("page_id", "lang", F.round("confidence", 6).alias("confidence"), "declared", "suffix", "host")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    marked = docs.select("doc_id", toxicity.scored(F.col("text"), model).alias("s"))
    return marked.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("s.score").alias("score"),
                         (F.col("s.score") >= 0.5).cast("int").alias("predicted"),
                         F.col("s.offending").alias("offending"))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each rebuilt to branch off the head of its family."""
    found = trie.build(*trie.rebuilt(stash(trie.in_order(read_table(spark, sf_dir, "conversations")), "trie-ordered")))
    hashed = stash(trie.ends_sha256(found.ends), "trie-end-hashes")
    nodes = found.nodes.join(hashed, ["depth", "k1", "k2"], "left")
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op12_token_files(spark: SparkSession, sf_dir: str, vocabulary: str = "word_bpe_49k.json") -> DataFrame:
    """Write the ids of every document to token files, and read them all back through the index."""
    root = scratch_dir(spark, "token-files")
    encoder = tokenfile.Encoder(public_tokenizers.path(vocabulary))
    index = tokenfile.write(read_table(spark, sf_dir, "documents"), root, encoder, end_id=1)
    found = tokenfile.read(index, root)
    return found.select("doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage all conversations by a fixed rule and repair them."""
    conversations = read_table(spark, sf_dir, "conversations")
    return repair.repair(conversations.select("conv_id").distinct(), repair.damaged(conversations))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_secret_scans, op2_quality_rules, op3_simhash_near_dedup, op4_byte_bpe, op5_warc, op6_url_filters, op7_document_fingerprints, op8_best_fit_packing, op9_language_id, op10_toxicity,
                            op11_conversation_prefix_trie, op12_token_files, op13_conversation_repair)
}

#: Operators that learn from data or compute hashes SQL lacks are tested against brute-force versions instead.
ORACLE_SQL: dict[str, str] = {
    "op5_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
        d AS (SELECT page_id, n, sha256(h) AS digest FROM p),
        f AS (SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY digest HAVING count(*) > 1),
        r AS (SELECT d.page_id, d.n, d.digest, CASE WHEN f.first <> d.page_id THEN f.first END AS refers_to
              FROM d LEFT JOIN f ON d.digest = f.digest)
        SELECT page_id, n AS payload_bytes, digest AS payload_digest,
               CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
        FROM r""",
    "op6_url_filters": r"""
        WITH p AS (SELECT page_id, DATE '2024-01-01' + CAST(page_id * 37 % 365 AS INT) AS fetched,
                          lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host
                   FROM pages),
        hosts AS (SELECT host, min(page_id) AS n FROM p WHERE host <> '' GROUP BY host),
        kinds AS (SELECT host, n, DATE '2024-01-01' + CAST(n % 200 AS INT) AS d,
                         CASE WHEN regexp_matches(host, 'adult|casino|bet') THEN 'unwanted' WHEN n % 5 = 0 THEN 'reported' END AS category
                  FROM hosts),
        wide AS (SELECT regexp_extract(host, '([^.]+\.)?[^.]*$', 0) AS domain, min(n) AS n FROM hosts GROUP BY 1),
        entries AS (
            SELECT host AS domain, category, 'add' AS action, d AS day FROM kinds WHERE category IS NOT NULL
            UNION SELECT host, category, 'remove', d + CAST(n % 60 + 30 AS INT) FROM kinds WHERE category IS NOT NULL AND n % 3 <> 0
            UNION SELECT host, category, 'add', d + 120 FROM kinds WHERE category IS NOT NULL AND n % 4 = 0
            UNION SELECT domain, 'outage', 'add', DATE '2024-01-01' + CAST(n % 200 AS INT) FROM wide
            UNION SELECT domain, 'outage', 'remove', DATE '2024-01-01' + CAST(n % 200 AS INT) + 7 FROM wide),
        daily AS (SELECT domain, category, day, min(action) AS action FROM entries GROUP BY ALL),
        spans AS (SELECT *, coalesce(lead(day) OVER (PARTITION BY domain, category ORDER BY day), DATE '9999-12-31') AS until FROM daily),
        met AS (SELECT p.page_id, p.host, p.fetched, s.domain, s.category, s.day
                FROM p JOIN spans s ON (p.host = s.domain OR ends_with(p.host, '.' || s.domain))
                 AND s.action = 'add' AND s.day <= p.fetched AND p.fetched < s.until),
        best AS (SELECT page_id, count(*) OVER (PARTITION BY page_id) AS n_active, domain, category, day,
                        row_number() OVER (PARTITION BY page_id ORDER BY length(domain) DESC, day DESC, category) AS r FROM met)
        SELECT p.page_id, CAST(p.fetched AS VARCHAR) AS fetched, p.host, coalesce(b.n_active, 0) AS n_active, b.page_id IS NOT NULL AS blocked,
               b.domain, b.category, CAST(b.day AS VARCHAR) AS valid_from
        FROM p LEFT JOIN best b ON b.page_id = p.page_id AND b.r = 1""",
}
