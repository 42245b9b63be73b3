"""The numbered operators on the given tables, with production parameters, and their SQL."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseframe.llm import (
    chat,
    classifier,
    decontaminate,
    exact_dedup,
    html_text,
    lm,
    merkle,
    near_dedup,
    packing,
    pii,
    repeats,
    variants,
    warc,
)

#: The vocabulary that packing counts tokens with.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: A key for the given tables only; real texts need one that is kept secret.
PSEUDONYM_KEY = b"key of the given tables"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_array_dedup(spark, sf_dir):
    return repeats.remove_repeats(_table(spark, sf_dir, "documents")).drop("spans")


def op2_minhash_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), percent=85, shingle=5)


def op3_best_fit_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER)


def op4_benchmark_decontamination(spark, sf_dir):
    return decontaminate.contaminated(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op5_pii_pseudonyms(spark, sf_dir):
    return pii.pseudonymise(_table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark, sf_dir):
    return lm.score_texts(_table(spark, sf_dir, "documents"))


def op8_warc_round_trip(spark, sf_dir):
    return warc.round_trip(_table(spark, sf_dir, "pages")).drop("url")


def op9_chat_preference_pairs(spark, sf_dir):
    conversations = _table(spark, sf_dir, "conversations")
    pairs = chat.preference_pairs(conversations, chat.adjacent_pairs(conversations))

    def told(mask):
        spans = F.transform(mask, lambda span: F.concat_ws("-", span["start"], span["end"]))
        return F.array_join(spans, ",").alias(mask)

    return pairs.select(
        "chosen_id",
        "rejected_id",
        "n_common",
        "prompt",
        "chosen",
        told("chosen_mask"),
        "rejected",
        told("rejected_mask"),
    )


def op10_quality_classifier(spark, sf_dir):
    return classifier.score_documents(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op11_spelling_variants(spark, sf_dir):
    return variants.spelling_variants(_table(spark, sf_dir, "documents"))


def op12_html_extraction(spark, sf_dir):
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op13_merkle_manifest(spark, sf_dir):
    """Proofs of all documents, checked against rows of which some have other text now."""
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = merkle.leaf_digest(text=F.translate("text", upper, upper.lower()))
    leaves = merkle.leaves_of(
        _table(spark, sf_dir, "documents"), changed_leaf=F.when(changed, lowered)
    )
    found = merkle.manifest(leaves).proofs()
    offered = found.withColumn("offered", F.coalesce("changed_leaf", "leaf"))
    return merkle.verify(offered, "offered").select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


QUERIES = {
    function.__name__: function
    for function in (
        op1_suffix_array_dedup,
        op2_minhash_near_dedup,
        op3_best_fit_packing,
        op4_benchmark_decontamination,
        op5_pii_pseudonyms,
        op6_exact_dedup,
        op7_lm_scoring,
        op8_warc_round_trip,
        op9_chat_preference_pairs,
        op10_quality_classifier,
        op11_spelling_variants,
        op12_html_extraction,
        op13_merkle_manifest,
    )
}

_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(text: str) -> str:
    parts = (
        f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"
        for value in ("doc_id", "source", "lang", "n_chars", text)
    )
    return f"sha256({' || '.join(parts)})"


def _crc32(text: str) -> str:
    """CRC-32 bit by bit: a byte comes in at the first of its eight steps."""
    hexed = f"hex(encode({text}))"
    steps = (
        f"list_transform(range(4 * strlen({hexed})), lambda s: CASE WHEN s % 8 = 0 THEN"
        f" CAST('0x' || substr({hexed}, s // 4 + 1, 2) AS BIGINT) ELSE 0 END)"
    )
    return (
        f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || {steps},"
        " lambda crc, byte: xor(xor(crc, byte) >> 1, 3988292384 * (xor(crc, byte) & 1))), 4294967295)"
    )


ORACLES = {
    "op6_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_spelling_variants": f"""
        WITH RECURSIVE runs AS (
            SELECT doc_id, run, count(*) AS n
            FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id,
                         unnest(regexp_extract_all({_LOWERED}, '[A-Za-zÀ-ÿ]+')) AS run
                  FROM documents)
            WHERE length(run) >= 6 GROUP BY ALL
        ), digests AS (
            SELECT run, n, {_crc32("doc_id || ':' || run")} AS digest FROM runs
        ), words AS (
            SELECT CASE WHEN digest % 199 = 0
                     THEN left(run, digest % length(run)) || substr(run, digest % length(run) + 2)
                     ELSE run END AS word,
                   CAST(sum(n) AS BIGINT) AS n
            FROM digests GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5
        ), shorter AS (
            SELECT word, place, left(word, place) || substr(word, place + 2) AS rest
            FROM (SELECT word, unnest(range(length(word))) AS place FROM words)
        ), pairs AS (
            SELECT a.word, b.word AS other FROM shorter a JOIN shorter b
                ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
            UNION SELECT w.word, s.word FROM words w JOIN shorter s ON s.rest = w.word
            UNION SELECT s.word, w.word FROM words w JOIN shorter s ON s.rest = w.word
        ), ranked AS (
            SELECT p.word, p.other, b.n AS other_n,
                   row_number() OVER (PARTITION BY p.word ORDER BY b.n DESC, encode(p.other)) AS place,
                   count(*) OVER (PARTITION BY p.word) AS n_near
            FROM pairs p JOIN words b ON b.word = p.other
        ), formed AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN other_n >= 5 * w.n THEN other END AS form,
                   CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
            FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1
        ), chains AS (
            SELECT word, word AS reached, 0 AS steps FROM formed
            UNION ALL
            SELECT c.word, f.form, steps + 1
            FROM chains c JOIN formed f ON f.word = c.reached AND f.form IS NOT NULL
        ), roots AS (
            SELECT word, max_by(reached, steps) AS root FROM chains GROUP BY word
        )
        SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
    """,
    # The given pages share a layout whose article SQL can cut out.
    "op12_html_extraction": r"""
        WITH articles AS (
            SELECT page_id, url, regexp_replace(regexp_replace(
                       regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'),
                       '</?(p|h1|br)>', ' ', 'g'), '</?b>', '', 'g') AS inner_text
            FROM pages
        ), texts AS (
            SELECT page_id, url, trim(regexp_replace(regexp_replace(
                       regexp_replace(inner_text, '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))
                       AS text
            FROM articles
        )
        SELECT page_id, url, text, length(text) AS n_chars FROM texts
    """,
    "op13_merkle_manifest": f"""
        WITH RECURSIVE leaves AS (
            SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf("text")} AS leaf,
                   CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN
                     {_leaf(_LOWERED)}
                   END AS changed
            FROM documents
        ), placed AS (
            SELECT *, row_number() OVER (
                       PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
                   count(*) OVER (PARTITION BY tree) AS size
            FROM leaves
        ), nodes AS (
            SELECT tree, 0 AS level, place, size, leaf AS digest FROM placed
            UNION ALL
            SELECT tree, level + 1, place // 16, (any_value(size) + 15) // 16,
                   sha256(string_agg(digest, '' ORDER BY place))
            FROM nodes WHERE size > 1 GROUP BY tree, level, place // 16
        ), subroots AS (
            SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS place,
                   count(*) OVER () AS size
            FROM nodes WHERE size = 1
        ), top AS (
            SELECT 0 AS level, place, size, digest FROM subroots
            UNION ALL
            SELECT level + 1, place // 16, (any_value(size) + 15) // 16,
                   sha256(string_agg(digest, '' ORDER BY place))
            FROM top WHERE size > 1 GROUP BY level, place // 16
        ), members AS (
            SELECT p.tree, p.place, n.level, n.place AS sibling, n.digest,
                   p.place // CAST(16 ** n.level AS BIGINT) AS own
            FROM placed p JOIN nodes n ON n.tree = p.tree AND n.size > 1
             AND n.place // 16 = p.place // CAST(16 ** (n.level + 1) AS BIGINT)
            UNION ALL
            SELECT p.tree, p.place, 1000 + n.level, n.place, n.digest,
                   s.place // CAST(16 ** n.level AS BIGINT)
            FROM placed p JOIN subroots s ON s.tree = p.tree JOIN top n ON n.size > 1
             AND n.place // 16 = s.place // CAST(16 ** (n.level + 1) AS BIGINT)
        ), steps AS (
            SELECT tree, place, level,
                   coalesce(string_agg(digest, '' ORDER BY sibling) FILTER (sibling < own), '')
                       AS before,
                   coalesce(string_agg(digest, '' ORDER BY sibling) FILTER (sibling > own), '')
                       AS after
            FROM members GROUP BY tree, place, level
        ), paths AS (
            SELECT tree, place, string_agg(before || after, '' ORDER BY level) AS proof,
                   list(before || '|' || after ORDER BY level) AS path
            FROM steps GROUP BY tree, place
        ), told AS (
            SELECT doc_id, leaf, s.digest AS subroot, (SELECT digest FROM top WHERE size = 1) AS root,
                   sha256(coalesce(proof, '')) AS proof_sha256,
                   list_reduce([coalesce(changed, leaf)] || coalesce(path, []), lambda digest, step:
                       sha256(split_part(step, '|', 1) || digest || split_part(step, '|', 2)))
                       AS folded_root
            FROM placed p JOIN subroots s ON s.tree = p.tree
            LEFT JOIN paths ON paths.tree = p.tree AND paths.place = p.place
        )
        SELECT *, folded_root = root AS verified FROM told
    """,
    "op8_warc_round_trip": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS payload,
                   strlen(coalesce(html, '')) AS payload_bytes
            FROM pages
        ), firsts AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM payloads
        )
        SELECT page_id, payload_bytes, sha256(payload) AS payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id
                    THEN first_id END AS refers_to
        FROM firsts
    """,
    "op9_chat_preference_pairs": """
        WITH turns AS (
            SELECT conv_id, conv_id // 2 AS pair, conv_id % 2 AS side,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place,
                   role, text,
                   '<|' || role || '|>' || chr(10) AS header,
                   replace(text, '<|', '< |') || '<|end|>' || chr(10) AS body
            FROM (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role,
                         coalesce(text, '') AS text
                  FROM conversations WHERE conv_id IS NOT NULL)
        ), pairs AS (
            SELECT pair FROM turns GROUP BY pair HAVING count(DISTINCT side) = 2
        ), compared AS (
            SELECT pair, place, count(*) = 2 AND count(DISTINCT (role, text)) = 1 AS same
            FROM turns SEMI JOIN pairs USING (pair) GROUP BY pair, place
        ), common AS (
            SELECT pair, coalesce(min(place) FILTER (NOT same) - 1, count(*)) AS n_common
            FROM compared GROUP BY pair
        ), placed AS (
            SELECT t.*, n_common,
                   coalesce(sum(length(header || body)) OVER (
                       PARTITION BY conv_id, place <= n_common ORDER BY place
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                       + length(header) AS body_start
            FROM turns t JOIN common USING (pair)
        ), sides AS (
            SELECT pair, side, any_value(n_common) AS n_common,
                   coalesce(string_agg(header || body, '' ORDER BY place)
                       FILTER (place <= n_common), '') AS prompt,
                   coalesce(string_agg(header || body, '' ORDER BY place)
                       FILTER (place > n_common), '') AS rest,
                   coalesce(string_agg(body_start || '-' || (body_start + length(body)), ','
                       ORDER BY place) FILTER (place > n_common AND role = 'assistant'), '') AS mask
            FROM placed GROUP BY pair, side
        )
        SELECT c.pair * 2 AS chosen_id, c.pair * 2 + 1 AS rejected_id,
               CAST(c.n_common AS INTEGER) AS n_common, c.prompt,
               c.rest AS chosen, c.mask AS chosen_mask,
               r.rest AS rejected, r.mask AS rejected_mask
        FROM sides c JOIN sides r ON c.pair = r.pair AND c.side = 0 AND r.side = 1
    """,
}
