"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitrec.llm.chat import preference_pairs
from visitrec.llm.kd_shards import shard_documents
from visitrec.llm.merkle import prove
from visitrec.llm.minhash import fingerprint_editions
from visitrec.llm.minhash import near_duplicates as minhash_groups
from visitrec.llm.ngram_join import near_duplicates
from visitrec.llm.outliers import quality_rules
from visitrec.llm.pii import KINDS, find_pii, fit_crf
from visitrec.llm.repair import Repair
from visitrec.llm.suffix_dedup import remove_repeats
from visitrec.llm.toxicity import fit_severity, severity
from visitrec.llm.unigram import encode
from visitrec.llm.warc import read_archives, write_archives
from visitrec.llm.winnow import benchmark_hits

from visitrec.storage import Scratch

#: The vocabulary file that the query uses; operators take the path as an argument.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_preference_formatting(spark: SparkSession, sf: str) -> DataFrame:
    """Each conversation against itself with the last assistant turn of its neighbour in place of its own."""
    turns = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    last = (
        turns.filter("role = 'assistant'")
        .groupBy("conv_id")
        .agg(F.max("turn").alias("last"), F.max_by("text", F.struct("turn", "text")).alias("reply"))
    )
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("reply").alias("other"))
    changed = F.when(F.col("turn") == F.col("last"), F.coalesce("other", F.lit(""))).otherwise(F.col("text"))
    rejected = (
        turns.join(last, "conv_id", "left")
        .join(other, "conv_id", "left")
        .select(F.col("conv_id").alias("pair_id"), "turn", "role", changed.alias("text"))
    )
    pairs = preference_pairs(turns.withColumnRenamed("conv_id", "pair_id"), rejected)
    for side in ("chosen", "rejected"):
        spans = F.transform(f"{side}_spans", lambda s: F.concat_ws(":", s["start"], s["end"]))
        pairs = pairs.withColumn(f"{side}_spans", F.array_join(spans, ","))
    return pairs.withColumnRenamed("pair_id", "conv_id")


def op2_ordinal_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents")
    return severity(documents, fit_severity(documents, _table(spark, sf, "labels")))


def op3_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(_table(spark, sf, "documents"), ngram=4, threshold=(85, 100))


def op4_warc_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    folder = Scratch(spark, "archives").path("warc")
    archives = write_archives(_table(spark, sf, "pages"), folder)
    return read_archives(archives, folder).drop("payload")


def op5_suffix_arrays(spark: SparkSession, sf: str) -> DataFrame:
    return remove_repeats(_table(spark, sf, "documents")).drop("kept")


def op6_crf_pii(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents")
    found = find_pii(documents, fit_crf(documents))

    def listed(spans: str) -> Column:
        each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(each, ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(listed("base"), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )


def op7_kd_tree(spark: SparkSession, sf: str) -> DataFrame:
    return shard_documents(_table(spark, sf, "documents"))


def op8_unigram_pieces(spark: SparkSession, sf: str) -> DataFrame:
    encoded = encode(_table(spark, sf, "documents"), PIECES)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


def op9_robust_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules(_table(spark, sf, "documents"))


def op10_winnowing(spark: SparkSession, sf: str) -> DataFrame:
    hits = benchmark_hits(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
    listed = F.sha2(F.array_join("items", ","), 256)
    return hits.withColumn("items_sha256", listed).drop("items")


def op11_merkle_butterfly(spark: SparkSession, sf: str) -> DataFrame:
    """Proofs of all documents; a third of them were lower-cased since."""
    documents = _table(spark, sf, "documents")
    touched = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = F.translate("text", _UPPER, _UPPER.lower())
    return prove(documents, altered={"text": F.when(touched, lowered).otherwise(F.col("text"))})


def op12_minhash(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents")
    return fingerprint_editions(documents, minhash_groups(documents))


def op13_repair_grammar(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations, damaged by a checksum of their place, and their repair."""
    table = _table(spark, sf, "conversations")
    space = F.lit(" ")
    key = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    case = F.crc32(F.concat_ws(":", *key)) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    copies = F.when(case == 0, 0).when(case == 3, 2).otherwise(1)
    damaged = table.select(
        "conv_id",
        "turn",
        F.when(case == 4, "user").otherwise(role).alias("role"),
        F.when(case == 1, "").when(case == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    )
    return Repair(damaged, every=table).summary()


QUERIES: dict[str, Query] = {
    "op1_preference_formatting": op1_preference_formatting,
    "op2_ordinal_toxicity": op2_ordinal_toxicity,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_warc_dictionary": op4_warc_dictionary,
    "op5_suffix_arrays": op5_suffix_arrays,
    "op6_crf_pii": op6_crf_pii,
    "op7_kd_tree": op7_kd_tree,
    "op8_unigram_pieces": op8_unigram_pieces,
    "op9_robust_outliers": op9_robust_outliers,
    "op10_winnowing": op10_winnowing,
    "op11_merkle_butterfly": op11_merkle_butterfly,
    "op12_minhash": op12_minhash,
    "op13_repair_grammar": op13_repair_grammar,
}


def _crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of an ASCII text, bit by bit."""
    byte = (
        "list_reduce(range(8), lambda v, z: xor(v >> 1, (v & 1) * 3988292384), xor(crc, b))"
    )
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ord(c) AS BIGINT))"
    return f"xor(list_reduce({codes}, lambda crc, b: {byte}, 4294967295), 4294967295)"


def _add(way: str, cost: str | int, edit: str, line: str = "''") -> str:
    return f"{{'c': {way}.c + {cost}, 'a': {way}.a || '{edit}', 'l': {way}.l || {line}}}"


def _repair_steps() -> tuple[str, str, str]:
    """SQL of the ways (cost, audit, lines) to the states after insertions, after a row's edit, and to the end."""
    user, assistant, kept = "chr(10) || 'user:'", "chr(10) || 'assistant:'", "chr(10) || role || ':' || text"
    both = f"{user} || {assistant}"
    inserted = f"""w0 AS i0, w1 AS i1,
        list_min([w2, {_add('w0', 5, 'I', user)}, {_add('w1', 5, 'I', user)}, {_add('w3', 5, 'I', user)}]) AS i2,
        list_min([w3, {_add('w2', 5, 'I', assistant)}, {_add('w0', 10, 'II', both)},
            {_add('w1', 10, 'II', both)}]) AS i3"""

    def stay(state: str, initial: str, role: str) -> str:
        keep = f"CASE WHEN {initial} = left(role, 1) AND NOT gone THEN 0 ELSE 1000000000 END + extra"
        ways = _add(state, keep, "K", kept)
        if role:
            change = "CASE WHEN gone THEN 1000000000 ELSE 1 END + extra"
            ways += ", " + _add(state, change, "R", f"chr(10) || '{role}:' || text")
        return ways

    edited = f"""{_add('i0', 2, 'D')} AS w0,
        list_min([{_add('i1', 2, 'D')}, {stay('i0', "'s'", '')}]) AS w1,
        list_min([{_add('i2', 2, 'D')}, {', '.join(stay(i, "'u'", 'user') for i in ('i0', 'i1', 'i3'))}]) AS w2,
        list_min([{_add('i3', 2, 'D')}, {stay('i2', "'a'", 'assistant')}]) AS w3"""
    return inserted, edited, "list_min([i0, i3])"


_INSERTED, _EDITED, _ENDED = _repair_steps()
# The contracts' patterns of words.
_SPACED = r"[^\x20\x09-\x0D]+"
_ALPHANUMERIC = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_NO_WAY = "{'c': CAST(1000000000 AS BIGINT), 'a': '', 'l': ''}"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}'), '{pattern}')"


def _windows(length: str) -> str:
    """SQL for all runs of ``length`` of the list ``words``, each as one text."""
    starts = f"range(1, len(words) - {length} + 2)"
    return f"list_transform({starts}, lambda i: array_to_string(words[i:i + {length} - 1], ' '))"


def _base32(hexadecimal: str) -> str:
    """SQL for the base32 form of 40 hexadecimal digits, four letters for five digits."""
    letters = " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> {shift}) & 31) + 1, 1)" for shift in (15, 10, 5, 0)
    )
    parts = f"list_transform(range(8), lambda k: CAST('0x' || substr({hexadecimal}, CAST(5 * k + 1 AS BIGINT), 5) AS INTEGER))"
    return f"array_to_string(list_transform({parts}, lambda v: {letters}), '')"


def _leaf(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    parts = [f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values]
    return f"sha256({' || '.join(parts)})"


ORACLE_SQL: dict[str, str] = {
    "op1_preference_formatting": """
WITH replies AS (
    SELECT conv_id, max(turn) AS last_turn, arg_max(text, turn) AS reply
    FROM conversations WHERE role = 'assistant' GROUP BY conv_id
), sides AS (
    SELECT c.conv_id, c.turn, c.role, c.text AS chosen,
        CASE WHEN c.turn = r.last_turn THEN coalesce(o.reply, '') ELSE c.text END AS rejected
    FROM conversations c
    LEFT JOIN replies r ON r.conv_id = c.conv_id
    LEFT JOIN replies o ON o.conv_id = xor(c.conv_id, 1)
), cuts AS (
    SELECT conv_id, min(CASE WHEN chosen <> rejected THEN turn END) AS cut FROM sides GROUP BY conv_id
), turns AS (
    SELECT s.*, c.cut IS NULL OR s.turn < c.cut AS shared,
        '<|' || replace(role, '<|', '< |') || '|>' || chr(10) AS head,
        replace(chosen, '<|', '< |') || '<|end|>' AS a, replace(rejected, '<|', '< |') || '<|end|>' AS b
    FROM sides s JOIN cuts c ON c.conv_id = s.conv_id
), placed AS (
    SELECT *,
        sum(CASE WHEN shared THEN 0 ELSE length(head || a) + 1 END) OVER w AS a_end,
        sum(CASE WHEN shared THEN 0 ELSE length(head || b) + 1 END) OVER w AS b_end
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
)
SELECT conv_id, CAST(count(*) FILTER (WHERE shared) AS INTEGER) AS n_prompt_turns,
    coalesce(string_agg(head || a || chr(10), '' ORDER BY turn) FILTER (WHERE shared), '') AS prompt,
    coalesce(string_agg(head || a || chr(10), '' ORDER BY turn) FILTER (WHERE NOT shared), '') AS chosen,
    coalesce(string_agg(head || b || chr(10), '' ORDER BY turn) FILTER (WHERE NOT shared), '') AS rejected,
    coalesce(string_agg((a_end - 1 - length(a)) || ':' || (a_end - 1), ',' ORDER BY turn)
        FILTER (WHERE NOT shared AND role = 'assistant'), '') AS chosen_spans,
    coalesce(string_agg((b_end - 1 - length(b)) || ':' || (b_end - 1), ',' ORDER BY turn)
        FILTER (WHERE NOT shared AND role = 'assistant'), '') AS rejected_spans
FROM placed GROUP BY conv_id
""",
    "op3_ngram_jaccard_join": f"""
WITH RECURSIVE split AS (
    SELECT doc_id, {_words('text', _SPACED)} AS words FROM documents
), sets AS (
    SELECT doc_id, list_sort(list_distinct(CASE WHEN len(words) >= 4 THEN {_windows('4')}
        WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END)) AS grams
    FROM split
), classes AS (
    SELECT min(doc_id) AS class, grams, len(grams) AS n FROM sets WHERE len(grams) > 0 GROUP BY grams
), spread AS (
    SELECT class, n, unnest(grams) AS gram FROM classes
), ranked AS (
    SELECT class, n, gram, row_number() OVER (PARTITION BY class ORDER BY held, gram) AS place
    FROM (SELECT *, count(*) OVER (PARTITION BY gram) AS held FROM spread)
), prefixes AS (
    SELECT class, n, gram FROM ranked WHERE place <= n - (85 * n + 99) // 100 + 1
), candidates AS (
    SELECT DISTINCT a.class AS a, b.class AS b FROM prefixes a JOIN prefixes b ON a.gram = b.gram
    WHERE a.class < b.class AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
), links AS (
    SELECT a, b FROM (
        SELECT c.a, c.b, x.n + y.n AS total, len(list_intersect(x.grams, y.grams)) AS shared
        FROM candidates c JOIN classes x ON x.class = c.a JOIN classes y ON y.class = c.b
    ) WHERE 100 * shared >= 85 * (total - shared)
), edges AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
    SELECT class AS a, class AS b FROM classes
    UNION
    SELECT r.a, e.b FROM reached r JOIN edges e ON e.a = r.b
), components AS (
    SELECT a AS class, min(b) AS component_id FROM reached GROUP BY a
)
SELECT s.doc_id, CAST(len(s.grams) AS BIGINT) AS n_shingles, coalesce(m.component_id, s.doc_id) AS component_id
FROM sets s LEFT JOIN classes c ON c.grams = s.grams LEFT JOIN components m ON m.class = c.class
""",
    "op4_warc_dictionary": f"""
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS largest
    FROM pages
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {_base32('sha1(payload)')} AS payload_digest,
    CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM payloads
""",
    "op10_winnowing": f"""
WITH texts AS (
    SELECT row_number() OVER () AS row, doc_id, {_words('text', _ALPHANUMERIC)} AS words FROM documents
), items AS (
    SELECT item_id, words, least(len(words), 10) AS size
    FROM (SELECT item_id, {_words('text', _ALPHANUMERIC)} AS words FROM benchmark)
), windows AS (
    SELECT DISTINCT item_id, size, unnest({_windows('size')}) AS content FROM items WHERE size > 0
), spots AS (
    SELECT row, size, unnest({_windows('size')}) AS content, unnest(range(1, len(words) - size + 2)) AS place
    FROM texts, (SELECT DISTINCT size FROM windows)
), hits AS (
    SELECT s.row, s.place, s.size, w.item_id FROM spots s JOIN windows w ON w.size = s.size AND w.content = s.content
), covered AS (
    SELECT row, count(DISTINCT word) AS n_hit
    FROM (SELECT row, unnest(range(place, place + size)) AS word FROM (SELECT DISTINCT row, place, size FROM hits)) GROUP BY row
), named AS (
    SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN covered USING (row) LEFT JOIN named USING (row)
""",
    "op11_merkle_butterfly": f"""
WITH RECURSIVE leaves AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
    FROM (
        SELECT doc_id, lang, {_leaf('text')} AS leaf, CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0
            THEN {_leaf(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} ELSE {_leaf('text')} END AS altered
        FROM documents
    )
), nodes AS (
    SELECT lang, 0 AS level, place, leaf AS digest, count(*) OVER (PARTITION BY lang) AS width FROM leaves
    UNION ALL
    SELECT lang, level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (any_value(width) + 7) // 8
    FROM nodes WHERE width > 1 GROUP BY lang, level, place // 8
), subroots AS (
    SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
    FROM nodes WHERE width = 1
), tops AS (
    SELECT 0 AS level, tree AS place, subroot AS digest, count(*) OVER () AS width FROM subroots
    UNION ALL
    SELECT level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (any_value(width) + 7) // 8
    FROM tops WHERE width > 1 GROUP BY level, place // 8
), below AS (
    SELECT a.lang, a.level, a.place,
        coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS l,
        coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS r
    FROM nodes a JOIN nodes b
        ON a.lang IS NOT DISTINCT FROM b.lang AND a.level = b.level AND a.place // 8 = b.place // 8
    WHERE a.width > 1 GROUP BY a.lang, a.level, a.place
), above AS (
    SELECT a.level, a.place,
        coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS l,
        coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS r
    FROM tops a JOIN tops b ON a.level = b.level AND a.place // 8 = b.place // 8
    WHERE a.width > 1 GROUP BY a.level, a.place
), steps AS (
    SELECT v.lang, v.place, 0 AS part, s.level, s.l, s.r
    FROM leaves v JOIN below s ON s.lang IS NOT DISTINCT FROM v.lang
        AND s.place = CAST(floor(v.place / pow(8, s.level)) AS BIGINT)
    UNION ALL
    SELECT v.lang, v.place, 1, s.level, s.l, s.r
    FROM leaves v JOIN subroots t ON t.lang IS NOT DISTINCT FROM v.lang
    JOIN above s ON s.place = CAST(floor(t.tree / pow(8, s.level)) AS BIGINT)
), paths AS (
    SELECT lang, place, list({{'l': l, 'r': r}} ORDER BY part, level) AS path,
        string_agg(l || r, '' ORDER BY part, level) AS siblings
    FROM steps GROUP BY lang, place
), proofs AS (
    SELECT v.doc_id, v.leaf, t.subroot, (SELECT digest FROM tops WHERE width = 1) AS root,
        sha256(coalesce(p.siblings, '')) AS proof_sha256,
        list_reduce(coalesce(p.path, []), lambda d, x: {{'l': sha256(x.l || d.l || x.r), 'r': ''}},
            {{'l': v.altered, 'r': ''}}).l AS folded_root
    FROM leaves v JOIN subroots t ON t.lang IS NOT DISTINCT FROM v.lang
    LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM v.lang AND p.place = v.place
)
SELECT *, folded_root = root AS verified FROM proofs
""",
    "op13_repair_grammar": f"""
WITH RECURSIVE cases AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS k
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
        CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM cases, (SELECT unnest([1, 2]) AS copy) WHERE k <> 0 AND (copy = 1 OR k = 3)
), ordered AS (
    SELECT *, row_number() OVER w AS place, left(role, 1) AS initial,
        lag(left(role, 1)) OVER w || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal,
        rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
    FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) AS copy FROM ordered
), judged AS (
    SELECT *, body = '' AS blank, body <> '' AND copy > 1 AS duplicate,
        body <> '' AND copy = 1 AND right(body, 1) NOT IN ('.', '!', '?') AS truncated
    FROM numbered
), edits AS (
    SELECT *, blank OR duplicate AS gone, CASE WHEN truncated THEN 5 ELSE 0 END AS extra FROM judged
), ways AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS place, {{'c': CAST(0 AS BIGINT), 'a': '', 'l': ''}} AS w0,
        {_NO_WAY} AS w1, {_NO_WAY} AS w2, {_NO_WAY} AS w3
    FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT conv_id, place, {_EDITED}
    FROM (
        SELECT w.conv_id, e.place, role, text, gone, extra, {_INSERTED}
        FROM ways w JOIN edits e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.place = w.place + 1
    )
), ends AS (
    SELECT conv_id, {_ENDED} AS way
    FROM (
        SELECT conv_id, {_INSERTED} FROM ways
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY place DESC) = 1
    )
), counts AS (
    SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
        count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
        count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE illegal) AS illegal
    FROM judged GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, e.way.c AS cost, e.way.a AS audit,
    sha256(e.way.l[2:]) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
""",
}
