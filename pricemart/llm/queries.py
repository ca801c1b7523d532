"""The registered queries of the operators, and their SQL where SQL can express them.

Every query applies its operator to its whole table and derives the digest columns from the operator's rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, language_id, line_dedup, lloyd, merge_automaton, pieces, quality, source_mix, spelling
from . import substring_dedup, topk_search
from .common import table
from .exact_dedup import exact_groups
from .near_dedup import near_groups

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


SQL["op6_exact_dedup"] = r"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS p
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY p) AS group_size,
       doc_id = first_value(doc_id) OVER best AS kept, sha256(p) AS text_sha256
FROM plain WINDOW best AS (PARTITION BY p ORDER BY n DESC, doc_id)
"""


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    passages = substring_dedup.repeated_passages(docs).select(
        "key", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
    return substring_dedup.for_every_row(docs, passages, "doc_id", "text")


SQL["op10_substring_dedup"] = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (
  SELECT doc_id, i, sha256(array_to_string(words[i:i + 34], ' ')) AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM split)),
repeated AS (SELECT run FROM starts GROUP BY run HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, i + k AS i
  FROM (SELECT doc_id, i FROM starts SEMI JOIN repeated USING (run)), (SELECT unnest(range(35)) AS k)),
words AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM split),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""


@query
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_groups(docs, shingle_words=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


SQL["op8_minhash_near_dedup"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, CASE WHEN len(words) < 3 THEN array_to_string(words, ' ')
                        ELSE array_to_string(words[i:i + 2], ' ') END AS s
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM split WHERE len(words) > 0))),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared >= 85 * (p.n + q.n - shared)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    by_text = line_dedup.kept_lines(*line_dedup.repeated_lines(docs)).select(
        "key", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )
    return substring_dedup.for_every_row(docs, by_text, "doc_id", "text")


SQL["op7_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
repeated AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(repeated.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE repeated.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN repeated ON keyed.k = repeated.k GROUP BY doc_id
"""


@query
def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = source_mix.mixture(table(spark, sf_dir, "documents"))
    mix = mix.select("row", "doc_id", "size", "source_size", "target", "taken", F.expr("get(draws, 0).time").alias("first_time"))
    return source_mix.training_order(mix, "first_time").drop("row")


def _source_mix_sql() -> str:
    times = " ".join(
        f"WHEN {k} THEN {source_mix.time_of('demand', s)}" for k, s in enumerate(source_mix.SCHEDULES)
    ).replace("D", "::DOUBLE").replace("EN::DOUBLE", "END")
    return rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(doc_id::VARCHAR) AS h FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM sized GROUP BY source),
levels AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((place - 1) % 3 + 1)::BIGINT] AS weight, 3 * source_size AS cap,
         cap / weight AS level FROM sources),
shares AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER lower_ones, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER lower_ones, 0)) AS share
  FROM levels WINDOW lower_ones AS (ORDER BY level, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
unit AS (SELECT arg_min(share, level) AS unit FROM shares WHERE level > share),
targets AS (
  SELECT source, place, source_size, least(weight * unit, cap::DOUBLE) AS target, round(target)::BIGINT AS words
  FROM shares, unit),
runs AS (
  SELECT doc_id, size, place, source_size, target, words, words // source_size AS whole,
         (sum(size) OVER (PARTITION BY place ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source),
taken AS (
  SELECT *, whole * size + greatest(0, least(size, words - whole * source_size - start)) AS taken,
         start / words::DOUBLE AS demand FROM runs)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken > 0 THEN CASE (place - 1) % 3 {times} END END AS first_time
FROM taken
"""


SQL["op1_source_mix"] = _source_mix_sql()


@query
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    more = spark.sql(f"SELECT -7L AS conv_id, t AS turn, r AS role, '{tricky}' AS text "
                     "FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)")
    chats = chat_format.format_chats(chats.unionByName(more))
    read = chats.select(
        "conv_id", "n_turns", F.char_length("formatted").cast("long").alias("formatted_chars"),
        chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.read_loss(F.col("segments")).alias("loss"), "valid", "first_bad_turn",
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars", "valid", "first_bad_turn",
    )


SQL["op3_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
placed AS (
  SELECT *, (row_number() OVER w - 1)::INT AS place, lag(role) OVER w AS before FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
measured AS (
  SELECT *, CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before IN ('system', 'assistant') THEN role = 'user'
                 ELSE before = 'user' AND role = 'assistant' END AS allowed,
         length(regexp_replace(text, '[\[<\\]', '12', 'g')) AS escaped,
         CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 16 WHEN 'assistant' THEN 10
                   ELSE 20 + length(regexp_replace(role, '[\[<\\]', '12', 'g')) END AS marks FROM placed)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(escaped + marks))::BIGINT AS formatted_chars,
       bool_and(allowed) AS valid, min(place) FILTER (WHERE NOT allowed) AS first_bad_turn
FROM measured GROUP BY conv_id
"""


@query
def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


SQL["op2_exact_topk"] = r"""
WITH parts AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024::DOUBLE * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM parts q, parts c WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def _fold(id_column: str, folds: int) -> Column:
    """The remainder of the checksum of an id as text; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    samples = language_id.learn(docs, _fold("doc_id", 5) != 0)
    held_out = F.coalesce(_fold("doc_id", 5) == 0, F.lit(False))
    return language_id.predict(docs, samples).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.Vocabulary()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = pieces.decode(pieces.encode(docs, vocabulary), vocabulary)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"), F.col("decoded").eqNullSafe(F.col("text")).alias("exact"),
    )


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(quality.labelled_sample(docs, table(spark, sf_dir, "labels"), _fold("doc_id", 3) != 1))
    held_out = F.coalesce(_fold("doc_id", 3) == 1, F.lit(False))
    return quality.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


@query
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lloyd.clusters(table(spark, sf_dir, "embeddings"), dims=64, k=8, rounds=10, seed="3")
    return found.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"),
    )


def _clustering_sql(rounds: int = 10) -> str:
    """Every round as three tables: who is nearest, the sums, and where the centroids go."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""
near{n} AS MATERIALIZED (
  SELECT row, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
  FROM (SELECT row, cluster, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
        FROM kept, centre{n}) GROUP BY row),
sums{n} AS (
  SELECT cluster, dim, count(*)::HUGEINT AS n, sum(v) AS s
  FROM (SELECT cluster, unnest(x) AS v, unnest(range(64)) AS dim FROM near{n} JOIN kept USING (row)) GROUP BY ALL),
centre{n + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(moved, c) AS c
  FROM centre{n} LEFT JOIN (
    SELECT cluster, list(((s - ((s % n) + n) % n) // n)::HUGEINT ORDER BY dim) AS moved FROM sums{n} GROUP BY cluster)
  USING (cluster)),""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda x: floor(1024::DOUBLE * x::DOUBLE)::HUGEINT) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
centre0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h) - 1)::INT AS cluster, x AS c
  FROM (SELECT sha256('3:' || vec_id) AS h, x FROM kept ORDER BY h LIMIT 8)),
{"".join(steps)}
each AS (SELECT cluster, sum(distance)::BIGINT AS cluster_inertia FROM near{rounds} GROUP BY cluster)
SELECT vec_id, cluster, distance::BIGINT AS distance, cluster_inertia,
       (SELECT sum(distance)::BIGINT FROM near{rounds}) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM near{rounds} JOIN kept USING (row) JOIN centre{rounds} USING (cluster) JOIN each USING (cluster)
"""


SQL["op11_centroid_clustering"] = _clustering_sql()


@query
def op12_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = merge_automaton.Vocabulary()
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = merge_automaton.encode(docs, vocabulary, packed=True, keep_text=False)
    return merge_automaton.decode(ids, vocabulary).select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(spelling.words(table(spark, sf_dir, "documents"), spoil_every=199))


def _spelling_sql() -> str:
    remainders = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        remainders.append(n)
    return rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents) GROUP BY ALL),
coded AS (
  SELECT w, c, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || w, ''), lambda x:
    CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
         ELSE [(192 | (unicode(x) >> 6))::BIGINT, (128 | (unicode(x) & 63))::BIGINT] END)) AS bytes FROM runs),
hashed AS (
  SELECT w, c, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda a, b:
    xor(a >> 8, ({remainders}::BIGINT[])[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM coded),
words AS MATERIALIZED (
  SELECT word, sum(c)::BIGINT AS n FROM (
    SELECT c, CASE WHEN h % 199 = 0 THEN w[1:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
gaps AS MATERIALIZED (
  SELECT word, n, p, length(word) AS size, word[1:p - 1] || word[p + 1:] AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)),
pairs AS (
  SELECT a.word, b.word AS other FROM gaps a JOIN gaps b ON a.p = b.p AND a.size = b.size AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT g.word, w.word FROM gaps g JOIN words w ON g.rest = w.word
  UNION SELECT w.word, g.word FROM gaps g JOIN words w ON g.rest = w.word),
best AS (
  SELECT pairs.word, count(*) AS n_near, arg_min(o.word, (-o.n, o.word)) AS form, max(o.n) AS form_n
  FROM pairs JOIN words o ON o.word = pairs.other GROUP BY pairs.word),
formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form END AS form,
         CASE WHEN form_n >= 5 * n THEN form_n END AS form_n FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS last, form AS next FROM formed
  UNION ALL SELECT chain.word, f.word, f.form FROM chain JOIN formed f ON f.word = chain.next)
SELECT formed.word, form, last AS root, n, n_near, form_n FROM formed JOIN chain ON chain.word = formed.word AND chain.next IS NULL
"""


SQL["op13_spelling_groups"] = _spelling_sql()
