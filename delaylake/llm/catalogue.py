"""Registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from delaylake.llm import (
    conversations,
    decontamination,
    katz,
    lexical,
    licenses,
    passages,
    personal,
    pieces,
    quality,
    sharding,
    simhash,
    substrings,
    urls,
    warc,
)

#: The rules of the URL query.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
SHARDS = 24


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.digest(_table(spark, sf, "documents"))


def op2_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(_table(spark, sf, "documents")).drop("spans")


def op3_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, rule string")
    pages = _table(spark, sf, "pages").select("page_id", "url")
    return urls.judge(pages, rules).drop("url")


def op4_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judged(_table(spark, sf, "documents"))


def op5_katz(spark: SparkSession, sf: str) -> DataFrame:
    return katz.score(_table(spark, sf, "documents"), katz.training())


def op6_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.dedup_classes(_table(spark, sf, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return substrings.deduplicated(docs, shared=passages.shared_words(docs))


def op8_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf, "pages"))


def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.leaks(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op10_sharding(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return sharding.shard(docs, SHARDS).selectExpr("*", "cast(null as int) as grown_shard")


def op11_conversations(spark: SparkSession, sf: str) -> DataFrame:
    return conversations.audit_of_damage(_table(spark, sf, "conversations"))


def op12_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.ranked(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op13_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return personal.digest(_table(spark, sf, "documents"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_license_scan": op2_license_scan,
    "op3_url_filter": op3_url_filter,
    "op4_quality_rules": op4_quality_rules,
    "op5_katz": op5_katz,
    "op6_simhash": op6_simhash,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_warc": op8_warc,
    "op9_decontamination": op9_decontamination,
    "op10_sharding": op10_sharding,
    "op11_conversations": op11_conversations,
    "op12_lexical_search": op12_lexical_search,
    "op13_personal_data": op13_personal_data,
}

ORACLE_SQL = {
    "op3_url_filter": r"""
with split as (
  select page_id,
    case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages),
parts as (
  select page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from split),
rules(rule, rule_host, rule_path, rule_verdict) as (values
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
met as (
  select p.page_id, r.rule, r.rule_verdict,
    row_number() over (partition by p.page_id order by length(r.rule) desc) as place
  from parts p join rules r
    on (p.host = r.rule_host or suffix(p.host, '.' || r.rule_host)) and starts_with(p.path, r.rule_path))
select p.page_id, p.host, p.path, m.rule, coalesce(m.rule_verdict, 'allow') as verdict
from parts p left join met m on m.page_id = p.page_id and m.place = 1
""",
    "op8_warc": """
with base as (
  select page_id, cast(octet_length(encode(coalesce(html, ''))) as bigint) as payload_bytes,
    sha1(coalesce(html, '')) as payload_digest
  from pages),
kept as (
  select *, case when payload_bytes >= 1000
    then max(page_id) over (partition by payload_digest) else page_id end as keeper
  from base)
select page_id, payload_bytes, payload_digest,
  case when keeper = page_id then 'response' else 'revisit' end as record_type,
  case when keeper = page_id then null else keeper end as refers_to
from kept
""",
    "op11_conversations": r"""
with recursive
given as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as code
  from conversations),
fated as (
  select *, xor(list_reduce(
      list_transform(string_split(code, ''), lambda c: cast(ascii(c) as bigint)),
      lambda crc, b: list_reduce(range(8), lambda v, k: xor(v >> 1, (v & 1) * 3988292384), xor(crc, b)),
      4294967295), 4294967295) % 20 as fate
  from given),
damaged as (
  select conv_id, turn, case when fate = 4 then 'user' else role end as role,
    case fate when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(case when fate = 3 then [1, 2] else [1] end) as copy
  from fated where fate <> 0),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
    substr(role, 1, 1) as initial
  from damaged),
numbered as (select *, row_number() over (partition by conv_id, role, text order by i) as seen from placed),
judged as (
  select *, case
      when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
      when seen > 1 then 'duplicate'
      when regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) not in ('.', '!', '?') then 'truncated' end as fault,
    lag(initial) over (partition by conv_id order by i) || initial as pair
  from numbered),
priced as (
  select conv_id, i, role, text, initial,
    case when fault in ('blank', 'duplicate') then 1000000 else 0 end + case when fault = 'truncated' then 1 else 0 end as stay
  from judged),
counts as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
  from judged group by conv_id),
back(conv_id, i, b) as (
  select conv_id, n + 1, [0, 4, 2, 0] from counts
  union all
  select conv_id, i, [least(base[1], 2 + base[3], 4 + base[4]), least(base[2], 2 + base[3], 4 + base[4]),
    least(base[3], 2 + base[4]), least(base[4], 2 + base[3])]
  from (
    select p.conv_id, p.i, [
      least(3 + b[1], stay + case when initial = 'u' then 0 else 2 end + b[3], stay + case when initial = 's' then 0 else 1000000 end + b[2]),
      least(3 + b[2], stay + case when initial = 'u' then 0 else 2 end + b[3]),
      least(3 + b[3], stay + case when initial = 'a' then 0 else 2 end + b[4]),
      least(3 + b[4], stay + case when initial = 'u' then 0 else 2 end + b[3])] as base
    from back join priced p on p.conv_id is not distinct from back.conv_id and p.i = back.i - 1) as step),
tight as (
  select a.conv_id, a.i, a.b, n.b as nb, p.role, p.text, p.initial, p.stay
  from back a
  left join back n on n.conv_id is not distinct from a.conv_id and n.i = a.i + 1
  left join priced p on p.conv_id is not distinct from a.conv_id and p.i = a.i),
walk(conv_id, i, state, audit, lines, open) as (
  select conv_id, cast(1 as bigint), 1, '', cast([] as varchar[]), true from counts
  union all
  select conv_id, case when move in ('I', '') then i else i + 1 end,
    case when move in ('D', '') then state when move = 'K' and initial = 's' then 2
      when state = 3 then 4 else 3 end,
    audit || move,
    case move when 'I' then list_append(lines, free || ':') when 'R' then list_append(lines, free || ':' || text)
      when 'K' then list_append(lines, role || ':' || text) else lines end,
    move <> ''
  from (
    select w.*, t.role, t.text, t.initial, case when state = 3 then 'assistant' else 'user' end as free,
      case when t.b[state] = 3 + t.nb[state] then 'D'
        when t.nb is null and state in (1, 4) then ''
        when t.b[state] = 2 + t.b[case when state = 3 then 4 else 3 end] then 'I'
        when initial = 's' and state = 1 and t.b[state] = stay + t.nb[2] then 'K'
        when initial = case when state = 3 then 'a' else 'u' end
          and t.b[state] = stay + t.nb[case when state = 3 then 4 else 3 end] then 'K'
        else 'R' end as move
    from walk w join tight t on t.conv_id is not distinct from w.conv_id and t.i = w.i
    where w.open) as step),
ids as (select distinct conv_id from conversations)
select ids.conv_id, coalesce(c.gaps, 0) as gaps, coalesce(c.blank, 0) as blank, coalesce(c.duplicate, 0) as duplicate,
  coalesce(c.truncated, 0) as truncated, coalesce(c.illegal, 0) as illegal, coalesce(cast(back.b[1] as bigint), 0) as cost,
  coalesce(w.audit, '') as audit, sha256(coalesce(array_to_string(w.lines, chr(10)), '')) as repaired_sha256
from ids
left join counts c on c.conv_id is not distinct from ids.conv_id
left join back on back.conv_id is not distinct from ids.conv_id and back.i = 1
left join walk w on w.conv_id is not distinct from ids.conv_id and not w.open
""",
    "op12_lexical_search": r"""
with found as (
  select doc_id, row_number() over () as row_no, text from documents),
terms as (
  select doc_id, row_no, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from found),
tfs as (select doc_id, row_no, term, count(*) as tf from terms group by all),
lengths as (select row_no, cast(sum(tf) as bigint) as n from tfs group by row_no),
totals as (select count(*) as documents, cast(sum(n) as bigint) as total from lengths),
weights as (
  select term, cast(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) as bigint) as w
  from tfs, totals group by term),
queries as (
  select item_id, row_number() over () as query_no, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
parts as (
  select q.item_id, q.query_no, t.doc_id, t.row_no,
    w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (25 + (75 * l.n * s.documents) // s.total))) as part
  from queries q join tfs t using (term) join weights w using (term) join lengths l on l.row_no = t.row_no, totals s),
scores as (
  select item_id, query_no, doc_id, cast(sum(part) as bigint) as score
  from parts group by item_id, query_no, doc_id, row_no)
select item_id, cast(place as integer) as rank, doc_id, score
from (
  select *, row_number() over (partition by query_no order by score desc, doc_id nulls first) as place
  from scores where score > 0)
where place <= 10
""",
    "op13_personal_data": personal.sql(),
}
