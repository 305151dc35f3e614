"""DuckDB SQL for the queries of this subpackage, where SQL can say what they compute."""

from __future__ import annotations

from itertools import permutations

_WORD = r"'[^\x20\x09-\x0D]+'"

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 100 = 0
)
SELECT query_id,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored
QUALIFY rank <= 10
"""

WORD_REPEATS = f"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS words FROM documents
),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 34], ' ') AS run
  FROM split, unnest(range(1, len(words) - 33)) AS t(i)
),
gone AS (
  SELECT DISTINCT doc_id, p
  FROM windows SEMI JOIN (SELECT run FROM windows GROUP BY run HAVING count(*) > 1) USING (run),
       unnest(range(i, i + 35)) AS u(p)
),
placed AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM split
),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept
  FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

#: Strings of 200 bytes as 400 hexadecimal digits of the text.
BYTE_REPEATS = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents),
sized AS (SELECT doc_id, digits, CAST(length(digits) // 2 AS BIGINT) AS n_bytes FROM docs),
strings AS (
  SELECT doc_id, i, md5(substr(digits, 2 * i + 1, 400)) AS run
  FROM sized, unnest(range(0, n_bytes - 199)) AS t(i)
),
repeated AS (
  SELECT doc_id, i FROM strings SEMI JOIN (SELECT run FROM strings GROUP BY run HAVING count(*) > 1) USING (run)
),
-- Places at which coverage by repeated strings begins and ends, and the removed runs.
edges AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200, true) AS fresh FROM repeated
),
runs AS (
  SELECT doc_id, min(i) AS first, max(i) + 200 AS past
  FROM (SELECT *, count(*) FILTER (fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM edges)
  GROUP BY doc_id, run
),
kept AS (
  SELECT doc_id, past AS since, lead(first) OVER (PARTITION BY doc_id ORDER BY first) AS until FROM runs
  UNION ALL
  SELECT doc_id, 0, min(first) FROM runs GROUP BY doc_id
),
left_over AS (
  SELECT doc_id, string_agg(substr(digits, 2 * since + 1, 2 * (coalesce(until, n_bytes) - since)), '' ORDER BY since) AS rest
  FROM kept JOIN sized USING (doc_id) GROUP BY doc_id
),
removed AS (
  SELECT doc_id, count(*) AS n_spans, CAST(sum(past - first) AS BIGINT) AS n_removed FROM runs GROUP BY doc_id
)
SELECT doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(rest, digits))) AS kept_sha256
FROM sized LEFT JOIN removed USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""

SOURCE_MIXING = f"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORD})) AS size,
         md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS turn
  FROM documents
),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM docs GROUP BY source
),
weighed AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sources
),
ending AS (SELECT *, 2 * source_size AS cap, 2 * source_size / weight AS ends FROM weighed),
levels AS (
  SELECT *, (sum(source_size) OVER () * 150 / 100
             - coalesce(sum(cap) OVER (ORDER BY ends, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY ends, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ending
),
time AS (SELECT level FROM levels WHERE level <= ends ORDER BY ends, rank LIMIT 1),
targets AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), weight * (SELECT level FROM time)) AS target
  FROM ending
),
queued AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY turn, size, doc_id
                                 ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
  FROM docs
)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, floor(target) - start))
            + greatest(0, least(size, floor(target) - start - source_size)) AS BIGINT) AS taken
FROM queued JOIN targets ON queued.source IS NOT DISTINCT FROM targets.source
"""

JACCARD_JOIN = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS words FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM split, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS t(i)
  WHERE len(words) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared
  JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 5 * shared.n >= 4 * (x.n + y.n - shared.n)
),
reach(doc_id, other) AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
),
classes AS (SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id),
counts AS (SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(classes.least, doc_id)) AS class_id,
       coalesce(counts.n, 0) AS n_links
FROM split LEFT JOIN classes USING (doc_id) LEFT JOIN counts USING (doc_id)
"""


def quality_rules() -> str:
    """Fences from values written out and sorted, one row per document and measure.

    The ordinary quantile is the 90th percentile (99th for repetition), fences lie four
    times its distance from the median beyond it, and a prior has 25 values, twice each.
    """
    order = "row_number() OVER (PARTITION BY {} ORDER BY cell) AS r, count(*) OVER (PARTITION BY {}) AS n"

    def prior(source: str, keys: str) -> str:
        by = f"{keys}measure"
        # The middles of 25 equal parts of the sorted values, twice.
        return f"""
  SELECT {keys}measure, min(cell) AS cell
  FROM (SELECT *, {order.format(by, by)} FROM {source}), range(25) i(k), range(2) twice(t)
  WHERE 50 * r >= (2 * k + 1) * n
  GROUP BY {keys}measure, k, t"""

    checks = [
        f"{m} <= max_{m}" for m in ("symbols", "dup_lines", "repeats", "upper", "word_len")
    ] + ["word_len >= min_word_len"]
    percent = {"symbols": 90, "dup_lines": 99, "repeats": 99, "upper": 90, "word_len": 90}
    middle = "min(cell) FILTER (measure = '{}' AND 100 * r >= {} * n)"

    def fence(m: str, p: int, name: str) -> str:
        return f"5 * {middle.format(m, p)} - 4 * {middle.format(m, 50)} AS {name}"

    wide = [fence(m, p, f"max_{m}") for m, p in percent.items()]
    wide.append(fence("word_len", 10, "min_word_len"))
    by = "lang, source, measure"
    return rf"""
WITH split AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), {_WORD}) AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS run
  FROM split, unnest(range(1, len(words) - 1)) AS t(i)
),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS times FROM windows),
       unnest(range(i, i + 3)) AS u(p)
  WHERE times > 1 GROUP BY doc_id
),
measured AS (
  SELECT doc_id, lang, source, len(words) AS n_words,
         length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(repeats.n, 0) AS n_repeat_words,
         len(lines) AS n_lines, len(regexp_extract_all(text, '[A-Z]')) AS n_upper
  FROM split LEFT JOIN repeats USING (doc_id)
),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         least(1000, 1000 * n_symbols // word_chars) AS symbols,
         least(1000, 1000 * n_dup_lines // n_lines) AS dup_lines,
         least(1000, 1000 * n_repeat_words // n_words) AS repeats,
         least(1000, 1000 * n_upper // word_chars) AS upper,
         least(1000, 10 * word_chars // n_words) AS word_len
  FROM measured
),
cells AS (
  SELECT lang, source, measure, cell FROM (
    UNPIVOT (SELECT lang, source, symbols, dup_lines, repeats, upper, word_len
             FROM judged WHERE NOT base_failed)
    ON symbols, dup_lines, repeats, upper, word_len INTO NAME measure VALUE cell)
),
overall AS ({prior("cells", "")}),
languages AS (
  SELECT lang, measure, cell FROM cells
  UNION ALL SELECT lang, measure, cell FROM (SELECT DISTINCT lang FROM cells), overall
),
by_lang AS ({prior("languages", "lang, ")}),
sources AS (
  SELECT lang, source, measure, cell FROM cells
  UNION ALL
  SELECT g.lang, source, measure, cell
  FROM (SELECT DISTINCT lang, source FROM cells) g JOIN by_lang l ON g.lang IS NOT DISTINCT FROM l.lang
),
fences AS (
  SELECT lang, source, {", ".join(wide)}
  FROM (SELECT *, {order.format(by, by)} FROM sources) GROUP BY lang, source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       CASE WHEN base_failed THEN false ELSE {" AND ".join(checks)} END AS kept
FROM judged j
LEFT JOIN fences g ON g.lang IS NOT DISTINCT FROM j.lang AND g.source IS NOT DISTINCT FROM j.source
"""

_LETTERS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Windows by their words and length; an item of fewer words than a window is one window.
DECONTAMINATION = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_LETTERS}) AS words FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, {_LETTERS}) AS words FROM benchmark
),
item_windows AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS n,
         array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS run
  FROM items, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS t(i)
  WHERE len(words) > 0
),
lengths AS (SELECT DISTINCT n FROM item_windows),
found AS (
  SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS run
  FROM docs, lengths, unnest(range(1, len(words) - n + 2)) AS t(i)
),
hits AS (
  SELECT doc_id, i, n, item_id FROM found JOIN item_windows USING (run, n)
),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(p) GROUP BY doc_id
),
listed AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS digest
  FROM hits GROUP BY doc_id
),
starts AS (
  SELECT doc_id, i, n, words[i:i + n + 1] AS context, win
  FROM (SELECT doc_id, words, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs)
    JOIN (SELECT DISTINCT n, string_split(run, ' ') AS win FROM item_windows) w ON word = win[1]
  WHERE n = 1 OR list_contains(words[i + 1:i + 3], win[2])
),
steps AS (
  SELECT *, 1 AS k, 1 AS place FROM starts
  UNION ALL
  SELECT doc_id, i, n, context, win, k + 1, place + list_position(context[place + 1:], win[k + 1])
  FROM steps WHERE k < n AND list_contains(context[place + 1:], win[k + 1])
),
near AS (
  SELECT doc_id, count(DISTINCT p) AS n_near
  FROM steps, unnest(range(i, i + place)) AS u(p) WHERE k = n GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_near, 0) AS n_near, coalesce(n_items, 0) AS n_items, coalesce(digest, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
  LEFT JOIN near USING (doc_id)
"""

#: CRC-32 byte by byte through a table of 256 remainders, which the first query derives.
IMPORTANCE_SAMPLING = f"""
WITH remainders AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, _:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS rest
  FROM range(256) t(b)
),
words AS (
  SELECT 'd' || doc_id AS id, regexp_extract_all({_LOWER}, {_LETTERS}) AS words FROM documents
  UNION ALL
  SELECT 'b', regexp_extract_all({_LOWER}, {_LETTERS}) FROM benchmark
),
runs AS (
  SELECT id, array_to_string(words[i:i + n - 1], ' ') AS run
  FROM words, range(1, 4) s(n), unnest(range(1, len(words) - n + 2)) AS t(i)
),
counted AS (SELECT id, run, count(*) AS n FROM runs GROUP BY ALL),
bytes AS (
  SELECT run, list_transform(range(CAST(octet_length(encode(run)) AS BIGINT)),
    lambda i: CAST('0x' || hex(encode(run))[2 * i + 1:2 * i + 2] AS BIGINT)) AS b
  FROM (SELECT DISTINCT run FROM counted)
),
hashed AS (
  SELECT run, xor(list_reduce(list_prepend(4294967295, b), lambda c, x:
    xor(c >> 8, rest[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, remainders
),
features AS (SELECT id, bucket, sum(n) AS n FROM counted JOIN hashed USING (run) GROUP BY ALL),
totals AS (
  SELECT range AS bucket, coalesce(sum(n) FILTER (id <> 'b'), 0) AS s,
         coalesce(sum(n) FILTER (id = 'b'), 0) AS t
  FROM range(10000) LEFT JOIN features ON bucket = range GROUP BY range
),
gains AS (
  SELECT bucket, floor(1000 * ln(CAST((t + 1) * (sum(s) OVER () + 10000) AS DOUBLE)
    / CAST((s + 1) * (sum(t) OVER () + 10000) AS DOUBLE))) AS gain
  FROM totals
),
weighed AS (
  SELECT id, sum(n) AS n_features, sum(n * gain) AS weight
  FROM features JOIN gains USING (bucket) GROUP BY id
),
scored AS (
  SELECT doc_id, len(words) AS size, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
         CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST('0x' || sha256('42:' || doc_id)[1:8] AS BIGINT) AS h
  FROM documents JOIN words ON words.id = 'd' || doc_id LEFT JOIN weighed USING (id)
),
noisy AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN size >= 20 AND place <= 5 * count(*) FILTER (size >= 20) OVER () // 100 THEN place END AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY size >= 20 ORDER BY score DESC, doc_id) AS place FROM noisy)
"""

_FILTER_ORDERS = ", ".join(
    f"('{order}')" for order in map("".join, permutations("ABCDE"))
)

FILTER_AUDIT = f"""
WITH failed AS (
  SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), {_WORD}) AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS smallest
  FROM documents
),
masks AS (
  SELECT part, doc_id,
         CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * len(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > smallest THEN 'E' ELSE '' END AS mask
  FROM failed
),
counted AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (quality = 1) AS good,
         count(*) FILTER (toxic = 1) AS toxic
  FROM masks LEFT JOIN labels USING (doc_id) GROUP BY part, mask
),
steps AS (
  SELECT filter_order, CAST(range AS INTEGER) AS step, filter_order[range] AS letter,
         filter_order[1:range - 1] AS before
  FROM (VALUES {_FILTER_ORDERS}) orders(filter_order), range(1, 6)
),
rows AS (
  SELECT part, filter_order, step, letter,
         sum(n) FILTER (translate(mask, before || letter, '') = mask) AS kept,
         sum(n) FILTER (contains(mask, letter) AND translate(mask, before, '') = mask) AS removed,
         sum(n) FILTER (contains(mask, letter) AND translate(mask, before, '') <> mask) AS redundant,
         sum(n) FILTER (mask = letter) AS unique_fails,
         sum(good) FILTER (contains(mask, letter) AND translate(mask, before, '') = mask) AS good_lost,
         sum(toxic) FILTER (contains(mask, letter) AND translate(mask, before, '') = mask) AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, step,
       CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, letter), 0) AS BIGINT) AS shapley
FROM rows
"""
