"""Registered queries of this package and their oracle SQL, one pair per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.llm import (
    block_ann, html_mincut, jaccard_tgm, langid_ftrl, maxent, pfair, quality_mcd, quotes, repair_cyk, revisits, sharding_lp, sp_scan, whitening_qr,
)
from stallwise.llm.common import crc_of_id, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_mcd.outliers(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality_mcd.COUNTS, "base_failed", "kept", "distance")


@query
def op2_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding_lp.sharded(sharding_lp.text_nodes(table(spark, sf_dir, "documents")), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op3_maximum_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.scored(table(spark, sf_dir, "documents"), crc_of_id() % 10 == 0)


@query
def op4_max_plus_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sp_scan.load()
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(F.col("text").cast("binary")).alias("crc"), F.octet_length("text").alias("size"))
    ids = sp_scan.encoded(rows, pieces).drop("text")
    exact = F.crc32(F.col("decoded").cast("binary")).eqNullSafe(F.col("crc")) & F.octet_length("decoded").eqNullSafe(F.col("size"))
    return sp_scan.decoded(ids, pieces).select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), exact.alias("exact"))


# Captures of every page: first fetch, not modified, changed page, not modified again. The same text in both dialects.
CAPTURES = {
    "record_id": "page_id * 4 + k",
    "url": "case k when 1 then concat(url, '#again') when 3 then replace(url, 'http', 'HTTP') else url end",
    "ts": "(page_id % 997) * 100 + k * 10",
    "status": "case when k in (1, 3) then 304 when page_id % 23 = 0 then 404 else 200 end",
    "etag": """case when page_id % 7 = 0 then null when k = 0 then concat('"', page_id, '"')
      when k = 1 then concat('W/"', page_id, '"') when k = 3 and page_id % 5 = 0 then '"stale"' else concat('"', page_id, 'b"') end""",
    "last_modified": "case when page_id % 11 = 0 then null else concat('day ', (page_id + case when k > 1 then 1 else 0 end) % 28) end",
    "headers": """case when k in (1, 3) then concat('Date: ', k, '\nCache-Control: max-age=', page_id % 60, '\nContent-Length: 0')
      else concat('Date: ', k, '\nContent-Type: text/html\nContent-Length: ', length(html), '\nVary: a\nVary: b\nCache-Control: no-cache') end""",
    "digest": "case when k in (1, 3) then null else md5(concat(html, k)) end",
    "body_bytes": "case when k in (1, 3) then null else cast(length(html) as bigint) end",
}


@query
def op5_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html", F.explode(F.array(*[F.lit(k) for k in range(4)])).alias("k"))
    return revisits.resolved(pages.selectExpr(*[f"{text} as {name}" for name, text in CAPTURES.items()]))


ORACLES["op5_revisit_resolution"] = (
    "with captures as (select " + ", ".join(f"{text.replace(chr(92) + 'n', chr(10))} as {name}" for name, text in CAPTURES.items())
    + " from (select *, unnest([0, 1, 2, 3]) as k from pages))"
    + r"""
, split as (
  select *, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1) as host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)', 1) as path,
    regexp_extract(url, '^[^?#]*[?]([^#]*)', 1) as query
  from captures
), keyed as (
  select *, case when host = '' then null else regexp_replace(lower(host), ':(80|443)$', '')
      || case when regexp_replace(path, '/+$', '') = '' then '/' else regexp_replace(path, '/+$', '') end
      || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(query, '&'), lambda p: p <> '' and not starts_with(p, 'utm_'))), '&'), ''), '') end as url_key
  from split
), full_records as (select * from keyed where status between 200 and 299 and url_key is not null
), latest as (
  select r.record_id, arg_max(f.record_id, f.ts * 1000000000 + f.record_id) as source
  from keyed r join full_records f on r.url_key = f.url_key and (f.ts < r.ts or (f.ts = r.ts and f.record_id < r.record_id))
  where r.status = 304 group by r.record_id
), told as (
  select r.*, f.record_id as source_id, f.digest as f_digest, f.body_bytes as f_bytes,
    case when r.status between 200 and 299 then 'response' when r.status <> 304 then 'other' when f.record_id is null then 'orphan'
      when coalesce(replace(r.etag, 'W/', '') = replace(f.etag, 'W/', ''), r.last_modified = f.last_modified) is null then 'unvalidated'
      when coalesce(replace(r.etag, 'W/', '') = replace(f.etag, 'W/', ''), r.last_modified = f.last_modified) then 'resolved' else 'mismatch' end as outcome
  from keyed r left join latest l on r.record_id = l.record_id left join keyed f on f.record_id = l.source
), lines as (
  select record_id, p.i, lower(trim(split_part(p.line, ':', 1))) as name, trim(substr(p.line, strpos(p.line, ':') + 1)) as value
  from (select record_id, unnest(list_zip(range(1, 20), string_split(headers, chr(10))), recursive := false) as z from keyed) q,
    lateral (select z[1] as i, z[2] as line) p where p.line is not null
), updates as (
  select t.record_id, l.i + 100 as i, l.name, l.value from told t join lines l on l.record_id = t.record_id
  where t.outcome = 'resolved' and l.name not in ('content-length', 'content-type')
), final_lines as (
  select * from updates
  union all
  select t.record_id, l.i, l.name, l.value from told t join lines l on l.record_id = t.source_id
  where t.outcome = 'resolved' and not exists (select 1 from updates u where u.record_id = t.record_id and u.name = l.name)
  union all
  select t.record_id, l.i, l.name, l.value from told t join lines l on l.record_id = t.record_id where t.outcome <> 'resolved'
), named as (select record_id, name, string_agg(value, ', ' order by i) as value from final_lines group by all
), texts as (select record_id, string_agg(name || ': ' || value, chr(10) order by name) as headers from named group by all
)
select t.record_id, t.url_key, t.ts, t.outcome, t.source_id,
  case when t.outcome = 'resolved' then t.f_digest when t.outcome = 'response' then t.digest end as digest,
  case when t.outcome = 'resolved' then t.f_bytes when t.outcome = 'response' then t.body_bytes end as body_bytes,
  x.headers
from told t left join texts x on x.record_id = t.record_id
"""
)


@query
def op6_langid_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = crc_of_id() % 5 == 0
    model = langid_ftrl.train(documents, ~held_out)
    return langid_ftrl.predicted(documents.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as a reply by mail: it quotes the turn before it, wrapped anew after every six words, and the first line of that
    one's own quote; every third turn quotes the first line of the turn before that."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = turns.groupBy("conv_id", F.col("turn").alias("at")).agg(F.min(F.split("text", "\n")[0]).alias("line"), F.min("text").alias("whole"))
    wrapped = F.regexp_replace(F.regexp_replace("whole", "[\n\r]+", " "), "((?:[^ ]+ ){5}[^ ]+) ", "$1\n> ")
    one = said.select("conv_id", (F.col("at") + 1).alias("turn"), wrapped.alias("wrapped1"))
    two = said.select("conv_id", (F.col("at") + 2).alias("turn"), F.col("line").alias("line2"))
    joined = turns.join(one, ["conv_id", "turn"], "left").join(two, ["conv_id", "turn"], "left")
    near = F.concat_ws("\n", F.concat(F.lit("> > "), "line2"), F.concat(F.lit("> "), "wrapped1"), "text")
    far = F.concat_ws("\n", F.concat(F.lit("> "), "line2"), "text")
    return joined.select("conv_id", "turn", "role", F.when(F.col("turn") % 3 == 2, far).otherwise(near).alias("text"))


@query
def op7_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.linked(mail(spark, sf_dir))


ORACLES["op7_quotation_linking"] = r"""
with recursive firsts as (
  select conv_id, turn, min(string_split(text, chr(10))[1]) as line, min(text) as whole from conversations group by all
), mail as (
  select c.conv_id, c.turn, c.role, case when c.turn % 3 = 2 then concat_ws(chr(10), '> ' || b.line, c.text)
    else concat_ws(chr(10), '> > ' || b.line,
      '> ' || regexp_replace(regexp_replace(a.whole, '[\n\r]+', ' ', 'g'), '((?:[^ ]+ ){5}[^ ]+) ', '\1' || chr(10) || '> ', 'g'), c.text) end as text
  from conversations c left join firsts a on a.conv_id = c.conv_id and a.turn = c.turn - 1
    left join firsts b on b.conv_id = c.conv_id and b.turn = c.turn - 2
), split as (
  select conv_id, turn, role, i, line, length(regexp_replace(regexp_extract(line, '^(( ?>)+) ?', 1), '[^>]', '', 'g')) as level,
    regexp_replace(line, '^(( ?>)+) ?', '') as content
  from (select conv_id, turn, role, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from mail)
), lines as (
  select *, lower(trim(regexp_replace(content, '[ 	]+', ' ', 'g'))) as said from split
), marked as (
  select *, case when lag(level) over (partition by conv_id, turn order by i) is not distinct from level then 0 else 1 end as starts from split
), runs as (
  select *, sum(starts) over (partition by conv_id, turn order by i) as run from marked
), passages as (
  select conv_id, turn, level, run, lower(trim(regexp_replace(string_agg(content, ' ' order by i), '[ 	]+', ' ', 'g'))) as said from runs group by all
), parts as (
  select conv_id, turn, level, said from lines
  union all
  select conv_id, turn, level, unnest(string_split(regexp_replace(said, '([.!?]) ', '\1' || chr(1), 'g'), chr(1))) from passages
), own as (select distinct conv_id, turn, said from parts where level = 0 and said <> ''
), asked as (select conv_id, turn, level, said, count(*) as times from parts where level > 0 and said <> '' group by all
), found as (
  select q.conv_id, q.turn, q.level, q.said, q.times, max(o.turn) as parent
  from asked q join own o on o.conv_id = q.conv_id and o.said = q.said and o.turn < q.turn group by all
), votes as (select conv_id, turn, level, parent, sum(times) as n from found group by all
), chosen as (
  select conv_id, turn, parent from votes
  qualify row_number() over (partition by conv_id, turn order by level, n desc, parent desc) = 1
), tree as (
  select m.conv_id, m.turn, m.role, c.parent from mail m left join chosen c on c.conv_id = m.conv_id and c.turn = m.turn
), reach as (
  select conv_id, turn, turn as root, 0 as depth from tree where parent is null
  union all
  select t.conv_id, t.turn, r.root, r.depth + 1 from tree t join reach r on r.conv_id = t.conv_id and r.turn = t.parent
), bodies as (
  select conv_id, turn, string_agg(line, chr(10) order by i) filter (level = 0) as body from lines group by all
)
select t.conv_id, row_number() over (partition by t.conv_id order by r.root, t.turn) - 1 as place, t.turn, t.role,
  t.parent as parent_turn, r.root as root_turn, cast(r.depth as int) as depth, b.body
from tree t join reach r on r.conv_id = t.conv_id and r.turn = t.turn join bodies b on b.conv_id = t.conv_id and b.turn = t.turn
"""


@query
def op8_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfair.mixed(table(spark, sf_dir, "documents").select("doc_id", "source"))


@query
def op9_token_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_tgm.joined(table(spark, sf_dir, "documents"))


ORACLES["op9_token_group_join"] = r"""
with recursive docs as (
  select doc_id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda w: w <> '') as w
  from documents
), sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) end as s
  from docs
), items as (select doc_id, len(s) as n, unnest(s) as t from sets
), inter as (
  select a.doc_id as x, b.doc_id as y, a.n as nx, b.n as ny, count(*) as c
  from items a join items b on a.t = b.t and a.doc_id <> b.doc_id and 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  group by all
), links as (select x, y from inter where 100 * c >= 90 * (nx + ny - c)
), reach as (
  select doc_id, doc_id as seen from sets
  union
  select r.doc_id, l.y from reach r join links l on r.seen = l.x
)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, min(r.seen) as component_id
from sets s join reach r on s.doc_id = r.doc_id group by s.doc_id, len(s.s)
"""


@query
def op10_block_matrix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return block_ann.nearest(vectors, F.col("vec_id") % 20 == 0, 20)


ORACLES["op10_block_matrix_join"] = """
with v as (
  select row_number() over () as number, vec_id, embedding::double[] as e from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored as (
  select q.number, q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e) as score
  from v q join v c on q.number <> c.number and len(q.e) = len(c.e)
  where q.vec_id % 20 = 0
), ranked as (
  select query_id, cast(row_number() over (partition by number order by score desc, vec_id) as int) as rank, vec_id, score
  from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""


@query
def op11_minimum_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_mincut.extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with faults by their checksum: dropped (marked ``gone``), emptied, without stops, repeated, or said by the user."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))
    return rows.withColumn("kind", F.crc32(name.cast("binary")) % 20).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (kind == 0).alias("gone"), F.explode(copies).alias("copy"))


@query
def op12_interval_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_cyk.with_digests(damaged(spark, sf_dir), F.col("gone"))


ORACLES["op12_interval_parsing"] = r"""
with recursive crc_table as (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
    xor(c >> 1, case when c & 1 = 1 then 3988292384::bigint else 0 end))) as t
), named as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as name
  from conversations
), marked as (
  select n.*, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(name, ''), lambda x: ascii(x)::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::bigint) % 20 as kind
  from named n, crc_table
), damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, copy
  from (select *, unnest(case when kind = 3 then [1, 2] else [1] end) as copy from marked where kind <> 0)
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, sha256(length(role) || ':' || role || text), copy) as i,
    rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') as said
  from damaged
), judged as (
  select *, case when said = '' then 'blank' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
    when right(said, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
    lag(left(role, 1)) over (partition by conv_id order by i) as before
  from placed
), counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
    count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (i > 1 and before || left(role, 1) not in ('su', 'ua', 'au')) as illegal, max(i) as n
  from judged group by conv_id
), closure(p, q, cost, audit, said) as (
  values (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []), (0, 2, 3, 'I', ['user:']), (1, 2, 3, 'I', ['user:']),
    (3, 2, 3, 'I', ['user:']), (2, 3, 3, 'I', ['assistant:']), (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 3, 6, 'II', ['user:', 'assistant:'])
), edits as (
  select j.conv_id, j.i, c.p, e.q, c.cost + e.cost as cost, c.audit || e.edit as audit, list_concat(c.said, e.said) as said
  from judged j, closure c, lateral (
    select c.q as q, 4 as cost, 'D' as edit, []::varchar[] as said
    union all
    select case left(j.role, 1) when 's' then 1 when 'u' then 2 else 3 end, case j.fault when 'truncated' then 3 else 0 end, 'K', [j.role || ':' || j.text]
    where j.fault not in ('blank', 'duplicate') and ((c.q = 0 and left(j.role, 1) = 's') or (c.q in (0, 1, 3) and left(j.role, 1) = 'u') or (c.q = 2 and left(j.role, 1) = 'a'))
    union all
    select case c.q when 2 then 3 else 2 end, case j.fault when 'truncated' then 6 else 3 end, 'R', [case c.q when 2 then 'assistant:' else 'user:' end || j.text]
    where j.fault not in ('blank', 'duplicate')
  ) e
), walk as (
  select distinct conv_id, 0::bigint as i, 0 as state, 0 as cost, '' as audit, []::varchar[] as said from judged
  union all
  select conv_id, i, state, best.cost, best.audit, best.said from (
    select w.conv_id, e.i, e.q as state, min({'cost': w.cost + e.cost, 'audit': w.audit || e.audit, 'said': list_concat(w.said, e.said)}) as best
    from walk w join edits e on e.conv_id is not distinct from w.conv_id and e.i = w.i + 1 and e.p = w.state
    group by w.conv_id, e.i, e.q
  )
), ended as (
  select c.conv_id, min({'cost': w.cost + k.cost, 'audit': w.audit || k.audit, 'said': list_concat(w.said, k.said)}) as best
  from counted c join walk w on w.conv_id is not distinct from c.conv_id and w.i = c.n join closure k on k.p = w.state and k.q in (0, 3)
  group by c.conv_id
), every as (select distinct conv_id from conversations)
select a.conv_id, coalesce(c.gaps, 0)::bigint as gaps, coalesce(c.blank, 0)::bigint as blank, coalesce(c.duplicate, 0)::bigint as duplicate,
  coalesce(c.truncated, 0)::bigint as truncated, coalesce(c.illegal, 0)::bigint as illegal, coalesce(e.best.cost, 0)::bigint as cost,
  coalesce(e.best.audit, '') as audit, sha256(coalesce(array_to_string(e.best.said, chr(10)), '')) as repaired_sha256
from every a left join counted c on c.conv_id is not distinct from a.conv_id left join ended e on e.conv_id is not distinct from a.conv_id
"""


@query
def op13_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening_qr.components(table(spark, sf_dir, "embeddings"), most=8)
