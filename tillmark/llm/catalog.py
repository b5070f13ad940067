"""Registered queries of the corpus operators, and their DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.native import LOWER, UPPER
from tillmark.llm import decontaminate, extract, linerules, mixing, quality, repeats, secrets, simhash
from tillmark.llm import spelling, tokenfiles, toxicity, urlrules, whitening

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linerules.judge_lines(table(spark, sf_dir, "documents")).drop("cleaned")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("digest")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge_urls(table(spark, sf_dir, "pages"), urlrules.rules_table(spark))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("digest", "n_near_items")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_text(table(spark, sf_dir, "pages"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in secrets.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.write_and_read(spark, table(spark, sf_dir, "documents"))


def registry() -> dict[str, Query]:
    listed = (
        op1_quality, op2_simhash, op3_line_rules, op4_mixing, op5_url_filter,
        op6_repeats, op7_decontaminate, op8_toxicity, op9_extract, op10_secrets,
        op11_whitening, op12_spelling, op13_token_files,
    )
    return {f.__name__: f for f in listed}


def _text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def line_rules_sql() -> str:
    symbols = linerules.SYMBOLS + "=_~^\\{}[]"
    strip = lambda of, chars: f"length(translate({of}, {_text(chars)}, ''))"
    return f"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t from documents
), p as (
  select r, doc_id, t,
    list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as ws,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as ls
  from d
), g as (
  select r, i, count(*) over (partition by r, array_to_string(ws[i:i + 4], ' ')) as n
  from (select r, ws, unnest(range(1, len(ws) - 3)) as i from p)
), c as (
  select r, count(distinct k) as n_repeat_words from (select r, unnest(range(i, i + 5)) as k from g where n > 1) group by r
), l as (
  select r, unnest(ls) as line from p
), j as (
  select r, line, right(folded, 1) not in ({', '.join(map(_text, linerules.ENDS))}) or folded in ({', '.join(map(_text, linerules.ENTRIES))})
    or length(line) - {strip('line', linerules.SEPARATORS)} >= {linerules.MIN_SEPARATORS}
    or 100 * (length(line) - {strip('line', symbols)}) > {linerules.MAX_SYMBOL_PERCENT} * length(line)
    or 100 * (length(line) - {strip('line', '!?')}) > {linerules.MAX_MARK_PERCENT} * length(line)
    or {' or '.join(f"contains(folded, {_text(p)})" for p in linerules.PHRASES)} as bad
  from (select *, lower(trim(line, {_text(linerules.BLANKS)})) as folded from l)
), m as (
  select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines, count(*) filter (where bad) as n_failing_lines,
    coalesce(sum(length(line)) filter (where bad), 0) as lost_chars, sum(length(line)) as line_chars
  from j group by r
), a as (
  select doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
    (length(t) - {strip('t', linerules.SYMBOLS)})::bigint as n_symbols,
    coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_failing_lines, 0)::bigint as n_failing_lines,
    coalesce(lost_chars, 0)::bigint as lost_chars, coalesce(line_chars, 0)::bigint as line_chars
  from p left join c using (r) left join m using (r)
), b as (
  select *, n_words < {linerules.MIN_WORDS} or 100 * n_repeat_words > {linerules.MAX_REPEATED_PERCENT} * n_words as base_failed from a
)
select *, not base_failed and 100 * lost_chars <= {linerules.MAX_LOST_PERCENT} * line_chars as kept from b"""


def mixing_sql() -> str:
    weights = " ".join(f"when {k} then {float(w)}" for k, w in enumerate(mixing.WEIGHTS))
    return f"""
with d as (
  select row_number() over () as r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
    md5(coalesce(source, '') || ':' || coalesce(doc_id::varchar, '')) as place
  from documents
), s as (
  select source, sum(size)::bigint as source_size from d group by source
), w as (
  select *, case (row_number() over (order by source is null, encode(source)) - 1) % {len(mixing.WEIGHTS)} {weights} end as weight from s
), f as (
  select *, {mixing.MAX_COPIES} * source_size / weight as room,
    sum({mixing.MAX_COPIES} * source_size) over o - {mixing.MAX_COPIES} * source_size as before,
    sum(weight) over (order by {mixing.MAX_COPIES} * source_size / weight, source is null, encode(source) rows between current row and unbounded following) as weights_left
  from w window o as (order by {mixing.MAX_COPIES} * source_size / weight, source is null, encode(source) rows unbounded preceding)
), v as (
  select *, ((select sum(source_size) from s) - before) / weights_left as level from f
), t as (
  select source, source_size, least({mixing.MAX_COPIES} * source_size::double, weight *
    (select level from v where level <= room order by room, source is null, encode(source) limit 1)) as target from v
), q as (
  select d.*, source_size, target, sum(size) over (partition by d.source order by place, doc_id, size rows unbounded preceding) as sent
  from d join t on d.source is not distinct from t.source
), c as (
  select *, (copy * source_size + sent) / target as finish from q, (select unnest(range({mixing.MAX_COPIES})) as copy)
  where copy * source_size < target and size > 0
), u as (
  select r, greatest(0, least(size, (select sum(size) from d) - (sum(size) over (order by finish, source is null, source, place, doc_id, size, copy rows unbounded preceding)) + size)) as used from c
), k as (
  select r, sum(used) as taken from u group by r
)
select doc_id, size, source, source_size, target, coalesce(taken, 0)::bigint as taken from q left join k using (r)"""


def url_filter_sql() -> str:
    rules = ", ".join("(" + ", ".join(map(_text, rule)) + ")" for rule in urlrules.RULES)
    return f"""
with u as (
  select row_number() over () as r, page_id, coalesce(regexp_extract(url, '(?s)^.*?://(.*)$', 1), '') as rest from pages
), p as (
  select r, page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') as host,
    regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) as path from u
), b as (
  select r, x.host || x.path as rule, verdict, row_number() over (partition by r order by length(x.host || x.path) desc, verdict desc) as k
  from p join (values {rules}) as x(verdict, host, path)
    on (p.host = x.host or p.host like '%.' || x.host) and starts_with(p.path, x.path)
)
select page_id, host, path, rule, coalesce(verdict, '{urlrules.DEFAULT}') as verdict from p left join (select * from b where k = 1) using (r)"""


def repeats_sql() -> str:
    n, block = repeats.LENGTH, 512  # bytes are pairs of hex digits; windows are cut from blocks, as long texts are slow to cut
    return f"""
with d as (
  select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents
), b as (
  select r, doc_id, origin, substr(h, 2 * origin + 1, {2 * (block + n - 1)}) as piece
  from (select r, doc_id, h, unnest(range(0, length(h) // 2, {block})) as origin from d)
), w as (
  select r, doc_id, origin + i as p, substr(piece, 2 * i + 1, {2 * n}) as s
  from (select r, doc_id, origin, piece, unnest(range(0, least({block}, length(piece) // 2 - {n - 1}))) as i from b)
), m as (
  select s, min(doc_id) as least from w group by s having count(*) > 1
), c as (
  select r, p, coalesce(p > lag(p) over (partition by r order by p) + {n}, true) as opens
  from w join m using (s) where least < doc_id or (doc_id is null and least is not null)
), g as (
  select r, p, sum(opens::int) over (partition by r order by p rows unbounded preceding) as run from c
), x as (
  select r, run, min(p) as a, max(p) + {n} as z from g group by r, run
), y as (
  select r, a, z, coalesce(lag(z) over (partition by r order by a), 0) as before from x
), k as (
  select r, sum(z - a)::bigint as n_removed, count(*) as n_spans, max(z) as last,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) as head
  from y join d using (r) group by r
)
select doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from d left join k using (r)"""


def decontaminate_sql() -> str:

    words = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    n = decontaminate.WINDOW
    return f"""
with i as (
  select item_id, {words} as ws from benchmark
), bw as (
  select distinct item_id, least(len(ws), {n}) as n, array_to_string(ws[k:k + {n - 1}], ' ') as phrase
  from (select item_id, ws, unnest(range(1, greatest(2, len(ws) - {n - 2}))) as k from i where len(ws) > 0)
), d as (
  select row_number() over () as r, doc_id, {words} as ws from documents
), dw as (
  select r, k, n, array_to_string(ws[k:k + n - 1], ' ') as phrase
  from (select r, ws, n, unnest(range(1, len(ws) - n + 2)) as k from d, (select distinct n from bw) where len(ws) >= n)
), o as (
  select r, k, bw.n, item_id from dw join bw on bw.phrase = dw.phrase and bw.n = dw.n
), h as (
  select r, count(distinct p) as n_hit from (select r, unnest(range(k, k + n)) as p from o) group by r
), t as (
  select r, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct r, item_id::varchar as id from o where item_id is not null) group by r
)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and {decontaminate.HIT_FRACTION} * coalesce(n_hit, 0) >= len(ws) as contaminated
from d left join h using (r) left join t using (r)"""


def spelling_sql() -> str:
    codes = spelling_crc_table()
    return f"""
with recursive codes as (
  select [{codes}]::uinteger[] as t
), runs as (
  select doc_id, run, count(*) as n from (
    select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{spelling.RUN.pattern}')) as run from documents)
  group by doc_id, run
), coded as (
  select run, n, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint)),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]::bigint)), 4294967295::bigint) as code
  from (select run, n, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as h from runs), codes
), words as (
  select word, sum(n)::bigint as n from (
    select n, case when code % {spelling.LOSES_ONE} = 0
      then substr(run, 1, (code % length(run))::bigint) || substr(run, (code % length(run))::bigint + 2) else run end as word from coded)
  where length(word) >= {spelling.LEAST_LENGTH} group by word having sum(n) >= {spelling.LEAST_COUNT}
), lost as (
  select word, n, i, substr(word, 1, i) || substr(word, i + 2) as rest from (select word, n, unnest(range(length(word))) as i from words)
), near as (
  select a.word, a.n, b.word as other, b.n as other_n from lost a join lost b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select a.word, a.n, b.word, b.n from lost a join words b on a.rest = b.word
  union select b.word, b.n, a.word, a.n from lost a join words b on a.rest = b.word
), ranked as (
  select *, count(*) over (partition by word) as n_near,
    row_number() over (partition by word order by other_n desc, encode(other)) as k from near
), formed as (
  select word, n_near, case when other_n >= {spelling.RATIO} * n then other end as form, case when other_n >= {spelling.RATIO} * n then other_n end as form_n
  from ranked where k = 1
), steps as (
  select word, word as root, 0 as depth from words
  union all select steps.word, form, depth + 1 from steps join formed on formed.word = steps.root where form is not null
), roots as (
  select word, arg_max(root, depth) as root from steps group by word
)
select word, form, root, n, coalesce(n_near, 0)::bigint as n_near, form_n from words join roots using (word) left join formed using (word)"""


def spelling_crc_table() -> str:
    """The 256 remainders of the cyclic redundancy check, by its rule."""
    found = []
    for k in range(256):
        for _ in range(8):
            k = (k >> 1) ^ (0xEDB88320 if k & 1 else 0)
        found.append(str(k))
    return ", ".join(found)


def oracles() -> dict[str, str]:
    return {
        "op3_line_rules": line_rules_sql(),
        "op4_mixing": mixing_sql(),
        "op5_url_filter": url_filter_sql(),
        "op6_repeats": repeats_sql(),
        "op7_decontaminate": decontaminate_sql(),
        "op12_spelling": spelling_sql(),
    }
