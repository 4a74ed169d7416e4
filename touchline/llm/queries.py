"""One query for each operator of this folder, with checking SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.ball_tree_search import ranked_search
from touchline.llm.conversation_repair import repair_conversations, repaired_digests
from touchline.llm.decontaminate import find_leaks
from touchline.llm.fingerprint import document_fingerprints
from touchline.llm.langid import identify, language_model
from touchline.llm.license_scan import NAMES, NOTICES, license_scan, license_texts
from touchline.llm.lm import score_documents
from touchline.llm.near_dedup import near_dedup
from touchline.llm.packing import pack
from touchline.llm.projection_forest import nearest
from touchline.llm.substring_dedup import substring_dedup
from touchline.llm.suffix_dedup import suffix_dedup
from touchline.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its checking SQL."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


_WORDS = r"list_filter(string_split_regex({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies; the package is installed wherever tasks run."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query(
    f"WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents), "
    "win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k FROM w, unnest(generate_series(1, len(ws) - 49)) t(i)), "
    "least AS (SELECT k, min(doc_id) AS first FROM win GROUP BY k), "
    "gone AS (SELECT DISTINCT doc_id, j FROM win JOIN least USING (k), unnest(generate_series(i, i + 49)) u(j) WHERE first < doc_id), "
    "tok AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM w), "
    "kept AS (SELECT t.doc_id, count(g.j) AS n_removed, string_agg(word, ' ' ORDER BY t.j) FILTER (g.j IS NULL) AS words "
    "FROM tok t LEFT JOIN gone g ON t.doc_id = g.doc_id AND t.j = g.j GROUP BY 1) "
    "SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256 "
    "FROM w LEFT JOIN kept USING (doc_id)"
)
def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of each document without passages of 50 words that an earlier document holds."""
    found = substring_dedup(documents(spark, sf), length=50)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query()
def op2_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Licence notices, also with a changed word, terms and file headers in documents."""
    return license_scan(documents(spark, sf), NOTICES, texts=license_texts(), names=NAMES)


@query()
def op3_language_model(spark: SparkSession, sf: str) -> DataFrame:
    """Log probabilities of all documents, learned from four fifths of the ids."""
    return score_documents(documents(spark, sf), least_context=1, least_seen=1)


@query()
def op4_document_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of each document and of an edited copy, and how alike they are."""
    found = document_fingerprints(documents(spark, sf))
    return found.withColumn("edited_sha256", F.sha2(F.col("edited_text").cast("binary"), 256)).drop("edited_text")


@query()
def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """The probability that a document is toxic, learned from the labels of three quarters of the ids."""
    return toxicity(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))


@query()
def op6_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """The language of each document, learned from four fifths of the ids."""
    docs = documents(spark, sf)
    return identify(docs, language_model(docs))


@query()
def op7_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Training sequences of at most 2048 tokens, as pieces of documents."""
    found = pack(documents(spark, sf), tokenizer_path("byte_bpe_50k.json"), limit=2048)
    return found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query()
def op8_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of each document without strings of 50 bytes that an earlier document holds."""
    found = suffix_dedup(documents(spark, sf), length=50)
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query(
    f"WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents), "
    "s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle FROM w, unnest(generate_series(1, greatest(len(ws) - 4, least(len(ws), 1)))) t(i)), "
    "n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1), "
    "common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2), "
    "links AS (SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)), "
    "ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links), "
    "reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, v.y FROM reach r JOIN ways v ON r.y = v.x), "
    "comp AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY 1) "
    "SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM comp LEFT JOIN n USING (doc_id)"
)
def op9_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of documents whose sets of five-word shingles have a similarity of 0.85 or more along links."""
    return near_dedup(documents(spark, sf), percent=85)


@query()
def op10_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold a test item, reordered or not."""
    return find_leaks(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


# CRC-32 of the text k, bit by bit.
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(k)), lambda i: ord(k[i + 1])::BIGINT)), "
    "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"
)


def _best(options: list[str]) -> str:
    return f"list_min([{', '.join(options)}])"


def _option(cost: str, edit: str, after: str) -> str:
    return f"{{'c': {cost} + {after}.c, 'a': '{edit}' || {after}.a}}"


def _row_step(state: int) -> str:
    """The best way from a state through one row, without turns inserted before it; v0 to v3 are the best ways after it."""
    options = [_option("2", "D", f"r.v{state}")]
    kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    never = "{'c': 1000000000000::BIGINT, 'a': ''}"
    for (at, initial), to in kept.items():
        if at == state:
            options.append(f"CASE WHEN d.stays AND d.initial = '{initial}' THEN {_option('d.more', 'K', f'r.v{to}')} ELSE {never} END")
    options.append(f"CASE WHEN d.stays THEN {_option('1 + d.more', 'R', f'r.v{(2, 2, 3, 2)[state]}')} ELSE {never} END")
    return _best(options)


def _inserted(state: int) -> str:
    chain = [f"b{state}"]
    at = state
    for n in (1, 2):
        at = (2, 2, 3, 2)[at]
        chain.append(f"{{'c': {5 * n} + b{at}.c, 'a': '{'I' * n}' || b{at}.a}}")
    return _best(chain)


_REPAIR_SQL = (
    "WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, "
    "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations), "
    f"h AS (SELECT *, {_CRC} % 20 AS code FROM c), "
    "g AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role, "
    "CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, "
    "unnest(CASE code WHEN 0 THEN []::INT[] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM h), "
    "n AS (SELECT *, left(role, 1) AS initial, right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS last, "
    "row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 32), md5(text), copy) AS i, "
    "row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM g), "
    "f AS (SELECT *, CASE WHEN last = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault, "
    "lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM n), "
    "d AS (SELECT *, fault NOT IN ('b', 'd') AS stays, CASE WHEN fault = 't' THEN 5 ELSE 0 END AS more FROM f), "
    "s AS (SELECT conv_id, max(i) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, "
    "count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, "
    "count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM d GROUP BY 1), "
    "r AS (SELECT conv_id, rows AS i, {'c': 0::BIGINT, 'a': ''} AS v0, {'c': 10::BIGINT, 'a': 'II'} AS v1, "
    "{'c': 5::BIGINT, 'a': 'I'} AS v2, {'c': 0::BIGINT, 'a': ''} AS v3 FROM s UNION ALL "
    f"SELECT conv_id, i, {', '.join(f'{_inserted(x)} AS v{x}' for x in range(4))} FROM ("
    f"SELECT r.conv_id, r.i - 1 AS i, {', '.join(f'{_row_step(x)} AS b{x}' for x in range(4))} "
    "FROM r JOIN d ON d.conv_id IS NOT DISTINCT FROM r.conv_id AND d.i = r.i) q), "
    "best AS (SELECT conv_id, v0.c AS cost, v0.a AS audit FROM r WHERE i = 0), "
    # Edits in order, each with the row that it takes and the role by its place.
    "e AS (SELECT conv_id, p, audit[p] AS edit, length(replace(left(audit, p), 'I', '')) AS i FROM best, unnest(generate_series(1, length(audit))) t(p)), "
    "o AS (SELECT e.conv_id, p, edit, d.role, d.text, d.initial = 's' AND edit = 'K' AS is_system FROM e LEFT JOIN d "
    "ON d.conv_id IS NOT DISTINCT FROM e.conv_id AND d.i = e.i AND e.edit <> 'I' WHERE edit <> 'D'), "
    "t AS (SELECT *, row_number() OVER w - count(*) FILTER (is_system) OVER w AS place FROM o WINDOW w AS (PARTITION BY conv_id ORDER BY p)), "
    "l AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || "
    "CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS lines FROM t GROUP BY 1), "
    "every AS (SELECT DISTINCT conv_id FROM conversations) "
    "SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, "
    "coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256 "
    "FROM every a LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM a.conv_id "
    "LEFT JOIN l ON l.conv_id IS NOT DISTINCT FROM a.conv_id"
)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) rows, damaged by the checksum of their conversation and turn; nulls are one space."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    code = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    changed = F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.when(code == 0, 0).when(code == 3, 2).otherwise(1)
    rows = conversations.select("conv_id", "turn", F.when(code == 4, "user").otherwise(role).alias("role"), changed.alias("text"), copies.alias("copies"))
    return rows.where("copies > 0").withColumn("copies", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("copies")


@query(_REPAIR_SQL)
def op11_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    """What the cheapest repair of each damaged conversation does, and a digest of its result."""
    given = spark.read.parquet(f"{sf}/conversations.parquet")
    found = repaired_digests(repair_conversations(damaged(given))).withColumnRenamed("conv_id", "_conv_id")
    every = given.select("conv_id").distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left").select(
        "conv_id",
        *[F.coalesce(f"summary.{c}", F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("summary.audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


@query()
def op12_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """The five nearest vectors that a forest of projection trees finds for every fiftieth id."""
    return nearest(spark.read.parquet(f"{sf}/embeddings.parquet"), k=5, every=50)


_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)


@query(
    f"WITH t AS (SELECT row_number() OVER () AS k, doc_id, {_TERMS} AS terms FROM documents), "
    "n AS (SELECT count(*) AS total, sum(len(terms))::BIGINT AS words FROM t WHERE len(terms) > 0), "
    "u AS (SELECT k, doc_id, len(terms) AS n, unnest(terms) AS term FROM t), "
    "f AS (SELECT k, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf FROM u GROUP BY k, term), "
    "w AS (SELECT term, floor(1000 * ln((2 * any_value(total) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM f, n GROUP BY term), "
    f"i AS (SELECT item_id, min(text) AS text FROM benchmark GROUP BY 1), q AS (SELECT item_id, unnest(list_distinct({_TERMS})) AS term FROM i), "
    "s AS (SELECT item_id, k, any_value(doc_id) AS doc_id, "
    "sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * total) // words))))::BIGINT AS score "
    "FROM q JOIN f USING (term) JOIN w USING (term), n GROUP BY item_id, k) "
    "SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s "
    "WHERE score > 0 QUALIFY rank <= 10"
)
def op13_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    """The ten documents that rank highest for each test item."""
    return ranked_search(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"), top=10)
