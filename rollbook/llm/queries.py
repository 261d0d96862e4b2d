"""The registered queries of this subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import functions as F

from rollbook.llm import (
    decontaminate, divergence, language_id, lexical_search, license_scan, line_dedup, mixing, near_dups,
    quality_rules, sharding, toxicity, url_filter, vector_search,
)
from rollbook.plans.registered import Query, table

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register


_WORD = r"[^\x20\x09-\x0D]+"


def held_out():
    """One document in three, told by its id alone, is kept out of all learning."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


@query()
def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(spark, docs, ~held_out())
    found = language_id.predict(docs, model, "doc_id")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query()
def op2_string_tiling(spark, sf_dir):
    found = decontaminate.matches(
        spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id"
    )
    best = F.sort_array(F.transform("items", lambda i: F.struct(i.coverage, -i.item_id)), asc=False)
    return found.select(
        "row.doc_id",
        (F.size("items") > 0).alias("contaminated"),
        F.size("items").alias("n_items"),
        F.transform("items", lambda i: i.item_id).alias("item_ids"),
        F.get(best, F.lit(0))["coverage"].alias("coverage"),
    )


@query()
def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    weights = toxicity.fit(spark, docs, table(spark, sf_dir, "labels"), ~held_out())
    found = toxicity.score(docs, weights, "doc_id")
    return found.select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


# Said again without hashes: all pairs that share a shingle, then the links' closure.
@query(rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'),
    '{_WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, w[i] || ' ' || w[i + 1] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM worded)
    UNION ALL SELECT doc_id, w[1] FROM worded WHERE len(w) = 1)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b
  ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * pairs.n >= 80 * (x.n + y.n - pairs.n)),
reached(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT other, root FROM reached JOIN (
    SELECT a AS one, b AS other FROM links UNION ALL SELECT b, a FROM links) ON one = reached.doc_id
  WHERE root < other)
SELECT reached.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id,
  reached.doc_id = min(root) AS kept
FROM reached LEFT JOIN sizes ON sizes.doc_id = reached.doc_id GROUP BY reached.doc_id""")
def op4_minhash_near_dups(spark, sf_dir):
    found = near_dups.verdicts(spark, table(spark, sf_dir, "documents"), words=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query(rf"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size FROM documents),
listed AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)),
turned AS (
  SELECT *, row_number() OVER t AS turn,
    sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER earlier, 0) AS rest,
    sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS remaining
  FROM listed
  WINDOW t AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, weight, source_size, source NULLS LAST),
    earlier AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, weight, source_size, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT rest, remaining FROM turned WHERE weight * rest <= 3 * source_size * remaining ORDER BY turn LIMIT 1),
aimed AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE),
    CAST(weight * level.rest AS DOUBLE) / CAST(level.remaining AS DOUBLE)) AS target
  FROM turned, level),
rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM aimed),
drawn AS (
  SELECT doc_id, sized.source, size, s AS seed,
    CAST(CAST('0x' || substr(md5((s // 4) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), 8 * (s % 4) + 1, 8)
      AS BIGINT) AS DOUBLE) / 4294967296.0 AS u
  FROM sized, range(0, 16) r(s)),
tried AS (
  SELECT rated.source, seed,
    abs(sum(CASE WHEN u < rate - floor(rate) THEN size ELSE 0 END)
      - any_value(target - floor(rate) * source_size)) AS miss
  FROM drawn JOIN rated ON rated.source IS NOT DISTINCT FROM drawn.source GROUP BY rated.source, seed),
chosen AS (
  SELECT source, seed FROM (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY miss, seed) AS place FROM tried) WHERE place = 1)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM drawn JOIN rated ON rated.source IS NOT DISTINCT FROM drawn.source
JOIN chosen ON chosen.source IS NOT DISTINCT FROM drawn.source AND chosen.seed = drawn.seed""")
def op5_mix_sources(spark, sf_dir):
    found = mixing.account(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


# Said again with the lines' texts: the least runs of 50 words from and up to each line.
@query(rf"""
WITH lined AS (
  SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
numbered AS (
  SELECT doc_id, l, i, len(regexp_extract_all(l[i + 1], '{_WORD}')) AS words
  FROM (SELECT doc_id, l, unnest(range(0, len(l))) AS i FROM lined)),
summed AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM numbered),
runs AS (
  SELECT a.doc_id, a.i AS s, min(b.i) + 1 AS e FROM summed a JOIN summed b
  ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.words >= 50 GROUP BY a.doc_id, a.i
  UNION
  SELECT a.doc_id, max(b.i), a.i + 1 FROM summed a JOIN summed b
  ON a.doc_id = b.doc_id AND b.i <= a.i AND a.upto - b.upto + b.words >= 50 GROUP BY a.doc_id, a.i),
told AS (
  SELECT runs.doc_id, s, e, row_number() OVER (
    PARTITION BY array_to_string(list_slice(l, s + 1, e), chr(10)) ORDER BY runs.doc_id, s) AS place
  FROM runs JOIN lined ON lined.doc_id = runs.doc_id),
removed AS (
  SELECT DISTINCT doc_id, unnest(range(s, e)) AS line FROM told WHERE place > 1),
islands AS (
  SELECT doc_id, min(line) AS s, max(line) + 1 AS e FROM (
    SELECT *, line - row_number() OVER (PARTITION BY doc_id ORDER BY line) AS island FROM removed)
  GROUP BY doc_id, island),
listed AS (
  SELECT doc_id, CAST(sum(e - s) AS INTEGER) AS n_removed, string_agg(s || '-' || e, ',' ORDER BY s) AS removed
  FROM islands GROUP BY doc_id)
SELECT documents.doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS INTEGER) AS n_lines,
  coalesce(n_removed, 0) AS n_removed, removed
FROM documents LEFT JOIN listed ON listed.doc_id = documents.doc_id""")
def op6_line_runs(spark, sf_dir):
    found = line_dedup.account(spark, table(spark, sf_dir, "documents"))
    spans = F.transform("spans", lambda x: F.concat_ws("-", x["start"], x["end"]))
    return found.select("doc_id", "n_lines", "n_removed", F.array_join(spans, ",").alias("removed"))


# The rules are written out here, apart from the operator's own list.
@query(rf"""
WITH words AS (
  SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
grams AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words)),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams)
  WHERE n > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM (
    SELECT doc_id, i, unnest(range(0, 8)) AS j FROM twice) GROUP BY doc_id),
lined AS (
  SELECT doc_id, count(*) AS n_lines, count(DISTINCT line) AS n_different FROM (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)
  WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id),
measured AS (
  SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_lines - n_different, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines,
    length(regexp_replace(coalesce(text, ''), '[^a-zA-Z]', '', 'g')) AS n_letters,
    length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS n_capitals,
    length(regexp_replace(coalesce(text, ''), '[\x00-\x7F]', '', 'g')) AS n_wide,
    len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS n_echoes
  FROM words LEFT JOIN repeated ON repeated.doc_id = words.doc_id
  LEFT JOIN lined ON lined.doc_id = words.doc_id),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words
    OR (n_letters >= 20 AND 2 * n_capitals > n_letters)
    OR (n_lines >= 4 AND 2 * n_dup_lines > n_lines)
    OR word_chars < 2 * n_words OR n_letters > 20 * n_words
    OR 2 * (n_letters + n_wide) < word_chars OR 5 * n_echoes > n_words) AS kept
FROM judged""")
def op7_quality_rules(spark, sf_dir):
    found = quality_rules.ledger(table(spark, sf_dir, "documents"), "doc_id")
    base = quality_rules.passes(F.col("failed"), "base-1")
    return found.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~base).alias("base_failed"), quality_rules.passes(F.col("failed")).alias("kept"),
    )


def _crc_table() -> str:
    """CRC-32 of every byte, by its rule."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        out.append(str(c))
    return ", ".join(out)


def _curve_sql(source: str, bits: int) -> str:
    """CTEs from ``source`` with x0, x1, x2 on: c0, c1, ... undo the turns level by level, the
    last one has the curve's place."""
    steps, last = [], source

    def step(replaced: str) -> None:
        nonlocal last
        steps.append(f"c{len(steps)} AS (SELECT * REPLACE ({replaced}) FROM {last})")
        last = f"c{len(steps) - 1}"

    for level in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(3):
            swap = f"(xor(x0, x{i}) & {level - 1})"
            turned = f"CASE WHEN x{i} & {level} > 0 THEN xor(x0, {level - 1}) ELSE xor(x0, {swap}) END AS x0"
            step(turned + (f", CASE WHEN x{i} & {level} > 0 THEN x{i} ELSE xor(x{i}, {swap}) END AS x{i}" if i else ""))
    step("xor(x1, x0) AS x1")
    step("xor(x2, x1) AS x2")
    turn = "CAST(0 AS BIGINT)"
    for level in (1 << b for b in range(bits - 1, 0, -1)):
        turn = f"xor({turn}, CASE WHEN x2 & {level} > 0 THEN {level - 1} ELSE 0 END)"
    step(", ".join(f"xor(x{i}, {turn}) AS x{i}" for i in range(3)))
    place = " + ".join(
        f"((x{i} >> {b}) & 1) * {1 << (3 * b + 2 - i)}" for b in range(bits - 1, -1, -1) for i in range(3)
    )
    steps.append(f"placed AS (SELECT *, {place} AS curve FROM {last})")
    return ", ".join(steps)


def _cells_sql(column: str, cells: int) -> str:
    return f"""{column}_cells AS (SELECT {column}, CAST(((2 * upto - n) * {cells}) // (2 * total) AS BIGINT) AS cell FROM (
  SELECT {column}, n, sum(n) OVER (ORDER BY {column}) AS upto, sum(n) OVER () AS total FROM (
    SELECT {column}, count(*) AS n FROM sized WHERE {column} IS NOT NULL GROUP BY {column})))"""


# Said again value by value, with the curve's turns written out.
@query(f"""
WITH crcs(crc_of) AS (SELECT [{_crc_table()}]::BIGINT[]),
bytes AS (
  SELECT doc_id, source, lang, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS b
  FROM documents),
sized AS (
  SELECT doc_id, source, lang, size, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
    lambda c, x: xor(c >> 8, crc_of[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS text_crc32 FROM bytes, crcs),
{_cells_sql("source", 1 << sharding.BITS)}, {_cells_sql("lang", 1 << sharding.BITS)}, {_cells_sql("size", 1 << sharding.BITS)},
celled AS (
  SELECT sized.*, coalesce(a.cell, 0) AS x0, coalesce(b.cell, 0) AS x1, coalesce(c.cell, 0) AS x2 FROM sized
  LEFT JOIN source_cells a ON a.source = sized.source LEFT JOIN lang_cells b ON b.lang = sized.lang
  LEFT JOIN size_cells c ON c.size = sized.size),
{_curve_sql("celled", sharding.BITS)},
numbered AS (
  SELECT *, row_number() OVER (ORDER BY curve, text_crc32, doc_id NULLS FIRST, size) - 1 AS place,
    count(*) OVER () AS total FROM placed)
SELECT doc_id, size, text_crc32, '{sharding.LAW}' AS law, CAST(place * 8 // total AS INTEGER) AS shard,
  place - (place * 8 // total * total + 7) // 8 AS slot, CAST(NULL AS INTEGER) AS grown_shard, curve FROM numbered""")
def op8_hilbert_shards(spark, sf_dir):
    found = sharding.shard(spark, table(spark, sf_dir, "documents"), "doc_id")
    return found.select(
        "doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


@query()
def op9_license_scan(spark, sf_dir):
    found = license_scan.scan(table(spark, sf_dir, "documents"), "doc_id")
    best = F.get(F.sort_array(F.transform("found", lambda f: F.struct(f.saved, f.license)), asc=False), F.lit(0))
    return found.select(
        "doc_id", "n_blocks", best["license"].alias("license"), best["saved"].alias("saved"),
        F.transform("found", lambda f: f.license).alias("licenses"),
    )


@query()
def op10_url_trees(spark, sf_dir):
    found = url_filter.judge(spark, table(spark, sf_dir, "pages").select("page_id", "url"))
    return found.select("row.page_id", "host", "path", "rule", "verdict", "score")


_FOLDED = f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')"
_SHARE = "1 + CAST(coalesce((CAST({n} + 5 AS HUGEINT) * 1000000000) // nullif({total} + 5 * {terms}, 0), 0) AS BIGINT)"


# Said again term by term: every group's share of every term its language keeps.
@query(rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    {_FOLDED} AS text FROM documents),
tokens AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS lang_n FROM tokens GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
langs AS (SELECT lang, count(*) AS terms, CAST(sum(lang_n) AS BIGINT) AS lang_total FROM kept GROUP BY lang),
counts AS (
  SELECT tokens.lang, source, tokens.term, count(*) AS n FROM tokens
  JOIN kept ON kept.lang = tokens.lang AND kept.term = tokens.term GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(terms, 0) AS terms, coalesce(lang_total, 0) AS lang_total,
    coalesce((SELECT CAST(sum(n) AS BIGINT) FROM counts c WHERE c.lang = g.lang AND c.source = g.source), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN langs ON langs.lang = g.lang),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
    {_SHARE.format(n="coalesce(n, 0)", total="total", terms="terms")} AS p,
    {_SHARE.format(n="lang_n", total="lang_total", terms="terms")} AS q
  FROM groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
apart AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
listed AS (
  SELECT * FROM pairs
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM listed)
WHERE part = 'pair' OR rank <= 50""")
def op11_source_divergence(spark, sf_dir):
    return divergence.audit(spark, table(spark, sf_dir, "documents"))


# Said again without vectors: every document's score of every item.
@query(rf"""
WITH worded AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
sized AS (SELECT r, doc_id, len(w) AS n FROM worded WHERE len(w) > 0),
corpus AS (SELECT count(*) AS N_docs, CAST(sum(n) AS BIGINT) AS L FROM sized),
tfs AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM worded) GROUP BY r, term),
items AS (
  SELECT row_number() OVER () AS i, item_id, list_distinct(
    regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (SELECT i, item_id, unnest(w) AS term FROM items),
weighed AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(N_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM tfs, corpus WHERE term IN (SELECT term FROM asked) GROUP BY term),
scored AS (
  SELECT i, item_id, sized.doc_id, tfs.r, CAST(sum(weight * ((1000000000 * tf)
    // (1000 * tf + 20 * (50 + (50 * n * N_docs) // L)))) AS BIGINT) AS score
  FROM asked JOIN weighed ON weighed.term = asked.term JOIN tfs ON tfs.term = asked.term
  JOIN sized ON sized.r = tfs.r, corpus GROUP BY i, item_id, sized.doc_id, tfs.r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored
  WHERE score > 0) WHERE rank <= 50""")
def op12_norm_buckets(spark, sf_dir):
    return lexical_search.rank_documents(
        spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


# Said again by all products.
@query("""
WITH whole AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.r <> q.r AND len(c.v) = len(q.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored)
WHERE rank <= 5""")
def op13_ball_tree(spark, sf_dir):
    return vector_search.nearest(spark, table(spark, sf_dir, "embeddings"))
