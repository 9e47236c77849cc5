"""SQL of another engine for the queries that SQL can express."""

from codeloom.llm.mixing import BLOCK_WORDS, SHARD_ROWS, SHARD_WORDS, STRIDE, WEIGHTS
from codeloom.llm.quality import FENCE, KEPT_BITS, MARGINS, MIN_GROUP

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"

EXACT_DEDUP = rf"""
with n as (select doc_id, length(coalesce(text, '')) as chars, regexp_replace(coalesce(text, ''), '{SPACE}', '', 'g') as body from documents),
g as (select *, first_value(doc_id) over (partition by body order by chars desc, doc_id) as keep_id, count(*) over (partition by body) as group_size from n)
select doc_id, keep_id, cast(group_size as bigint) as group_size, doc_id = keep_id as kept, sha256(body) as text_sha256 from g
"""

LINE_RUNS = rf"""
with l as (select doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) as lines from documents),
lv as (select unnest([1, 2, 4, 8, 16, 32, 64, 128, 256, 512, 1024, 2048, 4096, 8192]) as k),
p as (select doc_id, k, i, array_to_string(lines[i:i + k - 1], chr(10)) as body
      from (select doc_id, lines, k, unnest(range(1, len(lines) - k + 2)) as i from l join lv on k <= len(lines))),
e as (select *, row_number() over (partition by k, body order by doc_id, i) > 1 as later from p),
d as (select doc_id, i from e where k = 2 and later union select doc_id, i + 1 from e where k = 2 and later),
x as (select doc_id, list(i) as gone from d group by doc_id),
r as (select doc_id, max(k) as longest from e where later and k >= 2 group by doc_id)
select l.doc_id, cast(len(lines) as bigint) as n_lines, cast(coalesce(len(gone), 0) as bigint) as n_deleted, cast(coalesce(longest, 0) as bigint) as longest_run,
  sha256(coalesce(array_to_string([lines[j] for j in range(1, len(lines) + 1) if not coalesce(list_contains(gone, j), false)], chr(10)), '')) as kept_sha256
from l left join x on l.doc_id = x.doc_id left join r on l.doc_id = r.doc_id
"""

SUBSTRING = rf"""
with t as (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as words from documents),
w as (select doc_id, i, array_to_string(words[i:i + 19], ' ') as body from (select doc_id, words, unnest(range(1, len(words) - 18)) as i from t)),
e as (select doc_id, i, row_number() over (partition by body order by doc_id, i) > 1 as later from w),
g as (select distinct doc_id, unnest(range(i, i + 20)) as j from e where later),
n as (select doc_id, words, unnest(range(1, len(words) + 1)) as j from t),
k as (select n.doc_id, string_agg(n.words[n.j], ' ' order by n.j) as kept, count(*) as n_kept from n left join g on n.doc_id = g.doc_id and n.j = g.j
      where g.j is null group by n.doc_id)
select t.doc_id, cast(len(words) as bigint) as n_words, cast(len(words) - coalesce(n_kept, 0) as bigint) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from t left join k on t.doc_id = k.doc_id
"""

_RATES = {"symbols": "1000 * n_symbols // greatest(1, word_chars)", "capitals": "1000 * n_capitals // greatest(1, word_chars)",
          "dup_lines": "1000 * n_dup_lines // greatest(1, n_lines)", "repeats": "1000 * n_repeat_words // greatest(1, n_words)",
          "word_length": "100 * word_chars // greatest(1, n_words)"}
_CUT = f"greatest(0, length(bin(value)) - {KEPT_BITS})"

QUALITY = rf"""
with t as (select doc_id, lang, source, coalesce(text, '') as body, regexp_extract_all(coalesce(text, ''), '{WORD}') as words,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) as lines from documents),
w as (select doc_id, i, array_to_string(words[i:i + 4], ' ') as g from (select doc_id, words, unnest(range(1, len(words) - 3)) as i from t)),
tw as (select doc_id, i from (select *, count(*) over (partition by doc_id, g) as c from w) where c > 1),
rp as (select doc_id, count(*) as n from (select distinct doc_id, unnest(range(i, i + 5)) as j from tw) group by doc_id),
m as (select t.doc_id, lang, source, cast(len(words) as bigint) as n_words, length(regexp_replace(body, '{SPACE}', '', 'g')) as word_chars,
        length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) as n_symbols, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
        cast(coalesce(n, 0) as bigint) as n_repeat_words, length(regexp_replace(body, '[^A-Z]', '', 'g')) as n_capitals, cast(len(lines) as bigint) as n_lines
      from t left join rp on t.doc_id = rp.doc_id),
r as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed, {', '.join(f'{e} as {m}' for m, e in _RATES.items())} from m),
long as ({' union all '.join(f"select lang, source, '{m}' as measure, {m} as value from r where not base_failed" for m in MARGINS)}),
bins as (select lang, source, measure, (value >> {_CUT}) << {_CUT} as bin, count(*) as n from long group by all),
lev as (select 0 as level, lang, source, measure, bin, n from bins
  union all select 1, lang, null, measure, bin, sum(n) from bins group by lang, measure, bin
  union all select 2, null, null, measure, bin, sum(n) from bins group by measure, bin),
cum as (select *, sum(n) over (partition by level, lang, source, measure order by bin) as sofar, sum(n) over (partition by level, lang, source, measure) as whole from lev),
q as (select level, lang, source, measure, min(case when 4 * sofar >= whole then bin end) as q1, min(case when 4 * sofar >= 3 * whole then bin end) as q3,
        max(whole) as rows from cum group by level, lang, source, measure),
f as (select *, q3 + {FENCE} * (q3 - q1) + case measure {' '.join(f"when '{m}' then {v}" for m, v in MARGINS.items())} end as high,
        q1 - {FENCE} * (q3 - q1) - {MARGINS['word_length']} as low from q),
c as (select a.lang, a.source, a.measure,
        case when a.rows >= {MIN_GROUP} then a.high when b.rows >= {MIN_GROUP} then b.high else z.high end as high,
        case when a.rows >= {MIN_GROUP} then a.low when b.rows >= {MIN_GROUP} then b.low else z.low end as low
      from f a join f b on a.level = 0 and b.level = 1 and a.lang is not distinct from b.lang and a.measure = b.measure
      join f z on z.level = 2 and z.measure = a.measure),
o as (select r.doc_id, bool_or({' or '.join(f"(c.measure = '{m}' and r.{m} > c.high)" for m in MARGINS)} or (c.measure = 'word_length' and r.word_length < c.low)) as outside
      from r join c on r.lang is not distinct from c.lang and r.source is not distinct from c.source group by r.doc_id)
select r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not coalesce(outside, false) as kept
from r left join o on r.doc_id = o.doc_id
"""


def _hex(text: str, start: int = 1) -> str:
    return f"cast('0x' || substr({text}, {start}, 8) as bigint)"


def _apportion(name: str, parties: str, group: str, votes: str, seats: str, party: str) -> str:
    """Common table expressions that end in ``name``: the parties with ``won`` seats, all quotients ranked."""
    by = f"partition by {group}" if group else ""
    return f"""
{name}_v as (select *, count(*) over ({by}) as n_, sum(cast({votes} as double)) over ({by}) as v_ from {parties}),
{name}_l as (select *, case when v_ > 0 then {votes} / v_ else 0 end as s_ from {name}_v),
{name}_r as (select *, cast(greatest(0, floor(s_ * ({seats} - n_ / 2)) - 1) as bigint) as low_,
   cast(case when {votes} > 0 then ceil(s_ * ({seats} + n_ / 2)) + 1 else 0 end as bigint) as high_ from {name}_l),
{name}_q as (select *, {seats} - sum(low_) over ({by}) as rest_ from {name}_r),
{name}_k as (select *, unnest(range(low_, greatest(high_, low_))) as k_ from {name}_q),
{name}_w as (select *, row_number() over ({by} order by {votes} / (2 * k_ + 1) desc, {party}) as rank_ from {name}_k),
{name}_c as (select {group + ', ' if group else ''}{party}, count(*) as extra_ from {name}_w where rank_ <= rest_ group by all),
{name} as (select q.*, q.low_ + coalesce(c.extra_, 0) as won from {name}_q q left join {name}_c c on q.{party} = c.{party}{f' and q.{group} = c.{group}' if group else ''})"""


MIXING = rf"""
with z as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) as bigint) as size, md5('mix:' || cast(doc_id as varchar)) as draw from documents),
ss as (select source, cast(sum(size) as bigint) as source_size, count(*) as source_rows from z group by source),
s1 as (select *, row_number() over (order by source nulls last) as place from ss),
s2 as (select *, cast([{', '.join(map(str, WEIGHTS))}][(place - 1) % {len(WEIGHTS)} + 1] as bigint) as weight from s1),
s3 as (select *, 3 * sum(source_size) over () - coalesce(sum(4 * source_size) over (order by source_size / weight, place rows between unbounded preceding and 1 preceding), 0) as budget,
   sum(weight) over () - coalesce(sum(weight) over (order by source_size / weight, place rows between unbounded preceding and 1 preceding), 0) as weights from s2),
s4 as (select *, 4 * source_size * weights <= weight * budget as is_full from s3),
s5 as (select *, 3 * sum(source_size) over () - sum(case when is_full then 4 * source_size else 0 end) over () as rest, sum(case when is_full then 0 else weight end) over () as sharing from s4),
s6 as (select *, case when is_full then cast(2 * source_size as double) else cast(weight * rest as double) / cast(2 * sharing as double) end as target,
   cast(greatest(1, ceil(source_size / {SHARD_WORDS}), ceil(source_rows / {SHARD_ROWS})) as bigint) as shards,
   cast((3 * sum(source_size) over () + {BLOCK_WORDS}) // (2 * {BLOCK_WORDS}) as bigint) as blocks from s5),
{_apportion('src', 's6', '', 'target', 'blocks', 'place')},
pl as (select z.*, source_size, target, place, won as quota, {_hex('draw', 9)} % shards as shard from z join src on z.source is not distinct from src.source),
sh as (select place, shard, cast(sum(size) as bigint) as shard_size, any_value(quota) as quota from pl group by place, shard),
{_apportion('shd', 'sh', 'place', 'shard_size', 'quota', 'shard')},
sb as (select place, shard, won, cast(ceil(shard_size / {BLOCK_WORDS}) as bigint) as nb from shd),
sc as (select *, least(won, 2 * nb) // greatest(1, nb) as passes, least(won, 2 * nb) % greatest(1, nb) as part,
   {_hex("md5('mix:block:' || cast(place as varchar) || ':' || cast(shard as varchar))")} as turn from sb),
ln as (select pl.*, passes, part, turn, nb, cast(sum(size) over (partition by pl.place, pl.shard order by draw, doc_id rows unbounded preceding) as bigint) as stop
   from pl join sc on pl.place = sc.place and pl.shard = sc.shard),
li as (select *, stop - size as start from ln)
select doc_id, size, source_size, target, cast(passes * size + case when size > 0 and part > 0 then
   list_sum([case when (b * {STRIDE} + turn) % greatest(1, nb) < part then least(stop, (b + 1) * {BLOCK_WORDS}) - greatest(start, b * {BLOCK_WORDS}) else 0 end
             for b in range(start // {BLOCK_WORDS}, (stop - 1) // {BLOCK_WORDS} + 1)]) else 0 end as bigint) as taken
from li
"""
