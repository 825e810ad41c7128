"""The operators as named queries over the test tables, and the SQL that gives the same rows."""

from pyspark.sql import functions as F

from marketpulse.llm.bpe import token_digests
from marketpulse.llm.decontaminate import contaminated
from marketpulse.llm.exact_dedup import dedup_decisions
from marketpulse.llm.fill_in_middle import fill_in_middle, restored
from marketpulse.llm.licenses import license_scan
from marketpulse.llm.line_dedup import dedup_lines
from marketpulse.llm.prefix_trie import ordered_turns, trie_of, with_borrowed_starts
from marketpulse.llm.sharding import assign_shards
from marketpulse.llm.simhash import near_duplicates
from marketpulse.llm.substring_dedup import remove_shared
from marketpulse.llm.suffix_dedup import remove_repeats
from marketpulse.llm.token_counts import token_counts
from marketpulse.llm.toxicity import toxic_documents

QUERIES = {}
ORACLE = {}


def query(name, sql=None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLE[name] = sql
        return build

    return register


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_exact_dedup", """
WITH hashed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM hashed WINDOW same AS (PARTITION BY text_sha256)
""")
def op2_exact_dedup(spark, sf_dir):
    return dedup_decisions(read(spark, sf_dir, "documents"))


# The checksum table and the jumps are computed by their rules: SQL has functions for neither.
SHARD_SQL = """
WITH RECURSIVE
table_of AS (
  SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_concat([b::BIGINT], range(8)),
             lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) AS r(b))),
sized AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 1 AS size, hex(encode(coalesce(text, ''))) AS h
  FROM documents),
summed AS (
  SELECT doc_id, size,
         xor(list_reduce(list_concat([4294967295::BIGINT],
               list_transform(range(size - 1), lambda i: ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT)),
               lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) AS text_crc32
  FROM sized, table_of),
jumps(doc_id, shards, state, place, target) AS (
  SELECT doc_id, shards, CASE WHEN doc_id < 0 THEN doc_id + 18446744073709551616::HUGEINT ELSE doc_id::HUGEINT END,
         0::BIGINT, 0::BIGINT
  FROM documents, (VALUES (16), (17)) AS s(shards)
  UNION ALL
  SELECT doc_id, shards, n, target,
         floor((target + 1) * (2147483648::DOUBLE / ((n // 8589934592) + 1)::DOUBLE))::BIGINT
  FROM (SELECT *, ((state % 4294967296 * 2862933555777941757
                    + (state // 4294967296 * 2862933555777941757) % 4294967296 * 4294967296 + 1)
                   % 18446744073709551616) AS n
        FROM jumps WHERE target < shards)),
placed AS (
  SELECT doc_id, (max(place) FILTER (shards = 16))::INTEGER AS shard,
         (max(place) FILTER (shards = 17))::INTEGER AS grown_shard
  FROM jumps GROUP BY doc_id)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard
FROM summed JOIN placed USING (doc_id)
"""


@query("op3_sharding", SHARD_SQL)
def op3_sharding(spark, sf_dir):
    return assign_shards(read(spark, sf_dir, "documents"), shards=16)


def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op4_token_counts")
def op4_token_counts(spark, sf_dir):
    return token_counts(read(spark, sf_dir, "documents"), tokenizer_path())


@query("op8_bpe")
def op8_bpe(spark, sf_dir):
    return token_digests(read(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


@query("op1_license_scan")
def op1_license_scan(spark, sf_dir):
    return license_scan(read(spark, sf_dir, "documents"))


@query("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    return toxic_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op7_decontamination")
def op7_decontamination(spark, sf_dir):
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op5_simhash")
def op5_simhash(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"), width=3)


@query("op10_line_dedup", """
WITH each AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS n
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL)),
plain AS (
  SELECT doc_id, line, n, doc_id::HUGEINT * 1000000000 + n AS place, trim(regexp_replace(line,
           '[\\x09-\\x0D\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+',
           ' ', 'g')) AS p
  FROM each),
firsts AS (SELECT p, min(place) AS place FROM plain WHERE p <> '' GROUP BY p),
cuts AS (SELECT p, place, unnest(range(1, length(p) + 1)) AS i FROM firsts WHERE length(p) >= 20),
-- One other character: alike but for the character at a place. One character less: equal to another line.
changed AS (SELECT place, md5(substr(p, 1, i - 1) || chr(1) || substr(p, i + 1)) AS k FROM cuts),
shorter AS (SELECT DISTINCT place, md5(substr(p, 1, i - 1) || substr(p, i + 1)) AS k FROM cuts),
near AS (
  SELECT place FROM (SELECT place, min(place) OVER (PARTITION BY k) AS m FROM changed) WHERE place > m
  UNION
  SELECT greatest(s.place, f.place) FROM shorter s JOIN firsts f ON md5(f.p) = s.k AND length(f.p) >= 20),
judged AS (
  SELECT doc_id, line, n, p <> '' AND plain.place <> firsts.place AS repeated,
         plain.place = firsts.place AND near.place IS NOT NULL AS close
  FROM plain LEFT JOIN firsts USING (p) LEFT JOIN near ON near.place = plain.place),
kept AS (
  SELECT doc_id, count(*) FILTER (repeated) AS n_repeated, count(*) FILTER (close) AS n_near,
         greatest(count(*) FILTER (NOT (coalesce(repeated, FALSE) OR coalesce(close, FALSE))), 1) AS n_lines_left,
         coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT (coalesce(repeated, FALSE) OR coalesce(close, FALSE))), '') AS t
  FROM judged GROUP BY doc_id)
SELECT doc_id, coalesce(n_repeated, 0) AS n_repeated, coalesce(n_near, 0) AS n_near, n_lines_left, sha256(t) AS text_sha256
FROM documents LEFT JOIN kept USING (doc_id)
""")
def op10_line_dedup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return dedup_lines(docs.select("doc_id", "text"), least=1).select(
        "doc_id", "n_repeated", "n_near",
        F.size(F.split("text", "\n")).cast("long").alias("n_lines_left"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


@query("op9_suffix_dedup", """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT r, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM texts WHERE length(h) >= 400),
strings AS (SELECT r, i, md5_number(substr(h, (2 * i + 1)::BIGINT, 400)) AS s FROM starts),
repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS n FROM strings) WHERE n > 1),
marked AS (
  SELECT r, i, sum(CASE WHEN i - before <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS run
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM repeated)),
runs AS (SELECT r, min(i) AS a, max(i) + 200 AS b FROM marked GROUP BY r, run),
pieces AS (
  SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS start FROM runs),
kept AS (
  SELECT r, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed,
         string_agg(substr(h, (2 * start + 1)::BIGINT, (2 * (a - start))::BIGINT), '' ORDER BY a)
         || substr(any_value(h), (2 * max(b) + 1)::BIGINT) AS left_over
  FROM pieces JOIN texts USING (r) GROUP BY r)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(left_over, h))) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
""")
def op9_suffix_dedup(spark, sf_dir):
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", gone.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


TRIE_SQL = """
WITH table_of AS (
  SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_concat([b::BIGINT], range(8)),
             lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) AS r(b))),
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 5 AS leader, own,
         xor(list_reduce(list_concat([4294967295::BIGINT],
               list_transform(range(length(c::VARCHAR)), lambda i: ascii(substr(c::VARCHAR, i + 1, 1))::BIGINT)),
               lambda s, x: xor(s >> 8, t[xor(s & 255, x) + 1])), 4294967295) % 9 AS h
  FROM (SELECT c, count(*) AS own FROM turns GROUP BY c), table_of),
known AS (
  SELECT a.c, a.leader, a.h, least(a.h, coalesce(b.own, 0)) AS borrowed FROM convs a LEFT JOIN convs b ON b.c = a.leader),
rebuilt AS (
  SELECT k.c, i AS d, role, text FROM known k JOIN turns t ON t.c = k.leader AND i <= h
  UNION ALL
  SELECT k.c, i - h + borrowed, role, text FROM known k JOIN turns t ON t.c = k.c AND i > h),
prefixes AS (
  SELECT c, d, octet_length(encode(text)) AS n_bytes,
         string_agg(md5(md5(role) || md5(text)), '') OVER (PARTITION BY c ORDER BY d) AS k
  FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM convs),
nodes AS (
  SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(n_bytes) AS saved, substr(k, 1, 32 * (d - 1)) AS above
  FROM prefixes GROUP BY k, d),
children AS (SELECT above AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY above),
family AS (SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (k)),
below AS (
  SELECT substr(k, 1, 32 * up) AS k, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM (SELECT k, saved, n_children, unnest(range(0, d + 1)) AS up FROM family) GROUP BY 1),
ends AS (
  SELECT k, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
  FROM (SELECT c, arg_max(k, d) AS k FROM prefixes GROUP BY c) GROUP BY k)
SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, b.leaves AS n_leaves,
       b.saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM family f JOIN below b USING (k) LEFT JOIN ends USING (k)
LEFT JOIN family p ON f.d > 0 AND p.k = f.above
"""


@query("op11_prefix_trie", TRIE_SQL)
def op11_prefix_trie(spark, sf_dir):
    return trie_of(*with_borrowed_starts(*ordered_turns(read(spark, sf_dir, "conversations"))))


@query("op12_fill_in_middle", """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
tokens AS (
  SELECT *, regexp_extract_all(t, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS parts,
         ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM texts),
cuts AS (
  SELECT *, len(parts) AS n, least(h1 % (len(parts) + 1), h2 % (len(parts) + 1)) AS a,
         greatest(h1 % (len(parts) + 1), h2 % (len(parts) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50
              THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM tokens),
cut AS (
  SELECT *, array_to_string(parts[:a], '') AS p, array_to_string(parts[a + 1:b], '') AS m,
         array_to_string(parts[b + 1:], '') AS s
  FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
""")
def op12_fill_in_middle(spark, sf_dir):
    cut = fill_in_middle(read(spark, sf_dir, "documents"))
    back = restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


@query("op13_substring_dedup", """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
starts AS (
  SELECT r, doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM texts WHERE len(words) >= 50),
passages AS (
  SELECT r, doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS passage FROM starts),
repeated AS (
  SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY passage) AS first FROM passages)
  WHERE doc_id > first),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS place FROM repeated),
each AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY place) AS t, count(*) AS n
  FROM each ANTI JOIN gone USING (r, place) GROUP BY r)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
""")
def op13_substring_dedup(spark, sf_dir):
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return remove_shared(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", gone.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )
