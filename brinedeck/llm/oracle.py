"""SQL of the queries that SQL can express, for an engine with the driver tables as views.

The others have none: a tokenizer (1, 10), a greedy iteration over shards (4), trained models
(5, 7) and the xxHash of shingles (8) are tested against brute force, round trips or held-out labels.
"""

from __future__ import annotations

from brinedeck.llm import mixing, quality_rules

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


NEAREST = """with v as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0),
  d as (select q.vec_id as query_id, v.vec_id, sqrt(list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - v.e[i]) * (q.e[i] - v.e[i])), lambda x, y: x + y)) as score from v q join v on q.vec_id <> v.vec_id and len(q.e) = len(v.e) where q.vec_id % 100 = 0)
  select query_id, cast(row_number() over (partition by query_id order by score, vec_id) as integer) as rank, vec_id, score from d
  qualify row_number() over (partition by query_id order by score, vec_id) <= 10"""

BACKOFF = f"""with t as (select doc_id, {_words(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} as w from documents),
  k as (select doc_id, unnest(w) as w, generate_subscripts(w, 1) as i from t),
  b as (select doc_id, w, lag(w) over (partition by doc_id order by i) as p from k),
  c1 as (select w, count(*) as n from k group by w), o1 as (select doc_id, w, count(*) as n from k group by doc_id, w),
  c2 as (select p, w, count(*) as n from b where p is not null group by p, w), o2 as (select doc_id, p, w, count(*) as n from b where p is not null group by doc_id, p, w),
  d as (select doc_id, len(w) as n, greatest((select count(*) from k) - len(w), 1) as others from t),
  s as (select b.doc_id, case
      when c2.n - o2.n > 0 then log10((c2.n - o2.n) / (cp.n - op.n))
      when c1.n - o1.n > 0 then (case when b.p is null then 0 else log10(0.4) end) + log10((c1.n - o1.n) / d.others)
      else (case when b.p is null then 1 else 2 end) * log10(0.4) - log10(d.others) end as s
    from b join d on d.doc_id = b.doc_id join c1 on c1.w = b.w join o1 on o1.doc_id = b.doc_id and o1.w = b.w
    left join c2 on c2.p = b.p and c2.w = b.w left join o2 on o2.doc_id = b.doc_id and o2.p = b.p and o2.w = b.w
    left join c1 cp on cp.w = b.p left join o1 op on op.doc_id = b.doc_id and op.w = b.p)
  select d.doc_id, cast(any_value(d.n) as bigint) as n_words, round(coalesce(sum(s), 0), 4) as log10_sum, round(sum(s) / any_value(d.n), 6) as log10_mean
  from d left join s on s.doc_id = d.doc_id group by d.doc_id"""

BACKOFF_ORDER3 = f"""with t as (select doc_id, {_words(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} as w from documents),
  k as (select doc_id, unnest(w) as w, generate_subscripts(w, 1) as i from t),
  b as (select doc_id, w, lag(w) over x as p, lag(w, 2) over x as q from k window x as (partition by doc_id order by i)),
  o1 as (select doc_id, w, count(*) as n from k group by all), c1 as (select w, sum(n) as n from o1 group by all),
  o2 as (select doc_id, p, w, count(*) as n from b where p is not null group by all), c2 as (select p, w, sum(n) as n from o2 group by all),
  o3 as (select doc_id, q, p, w, count(*) as n from b where q is not null group by all), c3 as (select q, p, w, sum(n) as n from o3 group by all),
  d as (select doc_id, len(w) as n, greatest((select count(*) from k) - len(w), 1) as others from t),
  m as (select b.doc_id, d.others, case when b.p is null then 1 when b.q is null then 2 else 3 end as longest, c1.n - o1.n as n1, coalesce(c2.n - o2.n, 0) as n2,
      coalesce(c3.n - o3.n, 0) as n3, c1p.n - o1p.n as context1, c2p.n - o2p.n as context2
    from b join d using (doc_id) join c1 on c1.w = b.w join o1 on o1.doc_id = b.doc_id and o1.w = b.w
    left join c2 on c2.p = b.p and c2.w = b.w left join o2 on o2.doc_id = b.doc_id and o2.p = b.p and o2.w = b.w
    left join c3 on c3.q = b.q and c3.p = b.p and c3.w = b.w left join o3 on o3.doc_id = b.doc_id and o3.q = b.q and o3.p = b.p and o3.w = b.w
    left join c1 c1p on c1p.w = b.p left join o1 o1p on o1p.doc_id = b.doc_id and o1p.w = b.p
    left join c2 c2p on c2p.p = b.q and c2p.w = b.p left join o2 o2p on o2p.doc_id = b.doc_id and o2p.p = b.q and o2p.w = b.p),
  s as (select doc_id, case when n3 > 0 then log10(n3 / context2) when n2 > 0 then (longest - 2) * log10(0.4) + log10(n2 / context1)
      when n1 > 0 then (longest - 1) * log10(0.4) + log10(n1 / others) else longest * log10(0.4) - log10(others) end as s from m)
  select d.doc_id, cast(any_value(d.n) as bigint) as n_words, round(coalesce(sum(s), 0), 4) as log10_sum, round(sum(s) / any_value(d.n), 6) as log10_mean
  from d left join s on s.doc_id = d.doc_id group by d.doc_id"""

# level: the share of a weight of one; sources clamp in the order of cap / weight, and the right level is the one between two caps
MIX = f"""with t as (select doc_id, source, cast(len({_words("coalesce(text, '')")}) as bigint) as size, md5('{mixing.SEED}:' || doc_id) as o from documents),
  z as (select source, cast(sum(size) as bigint) as source_size, (array[5.0, 2.0, 1.0])[(row_number() over (order by source nulls last) - 1) % 3 + 1] as w from t group by source),
  r as (select *, cast(3 * source_size as double) as cap, sum(3 * source_size) over q as fixed, sum(w) over () - sum(w) over q as open, lead(3 * source_size / w) over q as next,
      sum(source_size) over () as total from z window q as (order by 3 * source_size / w, source nulls last)),
  l as (select coalesce(min(case when open > 0 and (total - fixed) / open < next then (total - fixed) / open end), 0) as inner_level,
      any_value(total) / sum(w) as first_level, min(cap / w) as lowest from r),
  g as (select source, source_size, cast(least(cap, w * (case when first_level < lowest then first_level else inner_level end)) as double) as target from r, l),
  h as (select *, case when source_size > 0 then least(floor(target / source_size + 1e-9), 3) else 0 end as whole from g),
  p as (select t.doc_id, t.size, t.o, h.*, greatest(target - whole * source_size, 0) as rest,
      sum(t.size) over (partition by t.source order by t.o, t.doc_id) as finish from t join h on t.source is not distinct from h.source),
  i as (select *, finish <= rest as inside, rest - coalesce(max(case when finish <= rest then finish end) over (partition by source), 0) as gap from p),
  x as (select *, not inside and abs(size - gap) < gap as fits from i),
  y as (select *, fits and row_number() over (partition by source, fits order by abs(size - gap), o, doc_id) = 1 as last from x)
  select doc_id, size, source_size, target, cast(least(whole + (case when inside or last then 1 else 0 end), 3) * size as bigint) as taken from y"""


def _rules_sql(risk: float = 0.03, delta: float = 0.1) -> str:
    ratio = lambda a, b: f"coalesce({a} / nullif({b}, 0), 0)"
    values = [
        ratio("word_chars", "n_words"), ratio("n_words", "word_chars"), ratio("n_symbols", "n_words"), ratio("n_dup_lines", "n_lines"),
        ratio("n_repeat_words", "n_words"), ratio("n_upper", "word_chars"), ratio("n_marks", "n_words"),
    ]
    n = len(values)
    classes = ", ".join(f"cast(floor(ln(cast({v} as double) + 0.001) * {quality_rules.CLASSES}) as integer)" for v in values)
    rate = risk / n
    return f"""with a as (select doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as text, {_words("coalesce(text, '')")} as w,
      list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from documents),
  u as (select doc_id, unnest(w) as w, generate_subscripts(w, 1) as i from a),
  g as (select doc_id, i, w || ' ' || lead(w) over q || ' ' || lead(w, 2) over q as g from u window q as (partition by doc_id order by i)),
  e as (select doc_id, unnest([i, i + 1, i + 2]) as i from (select *, count(*) over (partition by doc_id, g) as n from g where g is not null) where n > 1),
  rep as (select doc_id, count(distinct i) as n from e group by doc_id),
  m as (select doc_id, stratum, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
      cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
      cast(coalesce(rep.n, 0) as bigint) as n_repeat_words, len(lines) as n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_upper,
      length(regexp_replace(text, '[^!?]', '', 'g')) as n_marks from a left join rep using (doc_id)),
  f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, [{classes}] as class from m),
  c as (select stratum, unnest(range(1, {n + 1})) as rule, unnest(class) as class, quality = 1 as good from f join labels using (doc_id) where not base_failed and quality is not null),
  h as (select stratum, rule, class, count(*) filter (good) as good, count(*) filter (not good) as bad from c group by all),
  s as (select stratum, sum(good) as n_good, sum(bad) as n_bad, {delta} / (count(*) over () * {n}) as error from h where rule = 1 group by stratum),
  j as (select stratum, error, n_good, unnest(range(0, cast(ceil(n_good * {rate!r}) as bigint) + 1)) as j from s),
  pr as (select *, sum(case when j <= n_good then exp(lgamma(n_good + 1) - lgamma(j + 1) - lgamma(n_good - j + 1) + j * ln({rate!r}) + (n_good - j) * ln(1 - {rate!r})) else 0 end)
      over (partition by stratum order by j) as p from j),
  al as (select stratum, coalesce(max(j) filter (p <= error), -1) as allowed from pr group by stratum),
  ta as (select stratum, rule, class, sum(good) over q as good, sum(bad) over q as bad from h window q as (partition by stratum, rule order by class desc)),
  fit as (select ta.*, ta.bad / nullif(n_bad, 0) - ta.good / nullif(n_good, 0) as parts from ta join s using (stratum) join al using (stratum) where ta.good <= allowed),
  cut as (select stratum, rule, arg_max(class, (parts, class)) as cut from fit where parts > 0.001 group by stratum, rule),
  hit as (select f.doc_id from (select doc_id, stratum, unnest(range(1, {n + 1})) as rule, unnest(class) as class from f) f join cut using (stratum, rule) where f.class >= cut.cut)
  select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and doc_id not in (select doc_id from hit) as kept from f"""


def _ranked_sql() -> str:
    terms = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""with d as (select row_number() over () as r, doc_id, {terms} as w from documents),
  t as (select r, term, count(*) as tf from (select r, unnest(w) as term from d) group by all),
  s as (select count(*) as n_docs, cast(sum(len(w)) as bigint) as n_terms from d where len(w) > 0),
  q as (select distinct item_id, unnest({terms}) as term from benchmark),
  f as (select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as w from t, s group by term, n_docs),
  m as (select r, doc_id, 10 + (90 * len(w) * n_docs) // n_terms as m from d, s where len(w) > 0),
  x as (select item_id, r, doc_id, cast(sum(f.w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
    from q join f using (term) join t using (term) join m using (r) group by item_id, r, doc_id)
  select item_id, cast(row_number() over o as integer) as rank, doc_id, score from x where score > 0
  window o as (partition by item_id order by score desc, doc_id nulls last) qualify row_number() over o <= 10"""


REPEATS = """with d as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as x from documents),
  t as (select r, c, substr(x, 2 * c + 1, 2398) as x from (select r, x, unnest(range(0, len(x) // 2 - 199, 1000)) as c from d where len(x) >= 400)),
  w as (select r, c + p as p, md5_number(substr(x, 2 * p + 1, 400)) as s from (select r, c, x, unnest(range(0, len(x) // 2 - 199)) as p from t)),
  g as (select r, p, coalesce(p > lag(p) over (partition by r order by p) + 200, true) as fresh from w where s in (select s from w group by s having count(*) > 1)),
  i as (select r, p, sum(fresh::int) over (partition by r order by p) as span from g),
  e as (select r, span, min(p) as a, max(p) + 200 as b from i group by r, span),
  k as (select e.r, b - a as n, substr(d.x, 2 * coalesce(lag(b) over o, 0) + 1, 2 * (a - coalesce(lag(b) over o, 0))) as kept, a, b from e join d on d.r = e.r window o as (partition by e.r order by a)),
  c as (select r, sum(n) as n_removed, count(*) as n_spans, string_agg(kept, '' order by a) as kept, max(b) as done from k group by r)
  select doc_id, len(x) // 2 as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
    sha256(unhex(coalesce(kept || substr(x, 2 * done + 1), x))) as kept_sha256 from d left join c using (r)"""


def _framed(value: str) -> str:
    return f"coalesce(cast(strlen(cast({value} as varchar)) as varchar) || ':' || {value}, '-')"


def _merkle_sql() -> str:
    leaf = "sha256(concat({}))"
    fields = [_framed(f) for f in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = [*fields[:3], _framed("(n_chars + 1)"), fields[4]]
    fold = "case when s.h is null then sha256(c.folded) when c.idx % 2 = 1 then sha256(s.h || c.folded) else sha256(c.folded || s.h) end"
    level = "select {0}, lvl + 1 as lvl, idx // 2 as idx, (n + 1) // 2 as n, sha256(string_agg(h, '' order by idx)) as h from {1} where n > 1 group by {0}, lvl, idx // 2, n"
    step = "select {0}, c.lvl + 1, c.idx // 2, (c.n + 1) // 2, " + fold + ", c.way || coalesce(s.h, '') from {1} c left join {2} s on {3} s.lvl = c.lvl and s.idx = xor(c.idx, 1) where c.n > 1"
    crc = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint))), lambda a, b:
      list_reduce(list_prepend(xor(a, b), [cast(0 as bigint) for k in range(8)]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""
    return f"""with recursive a as materialized (select doc_id, lang, {leaf.format(", ".join(fields))} as leaf,
      case when {crc} % 7 = 0 then {leaf.format(", ".join(changed))} else {leaf.format(", ".join(fields))} end as own from documents),
  p as materialized (select *, row_number() over () as r, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by lang) as n,
      dense_rank() over (order by lang nulls first) - 1 as tree from a),
  up as (select tree, 0 as lvl, idx, n, leaf as h from p union all {level.format("tree", "up")}),
  tops as materialized (select tree as idx, count(*) over () as n, h from up where n = 1),
  above as (select 0 as tree, 0 as lvl, idx, n, h from tops union all {level.format("tree", "above")}),
  c1 as (select r, tree, 0 as lvl, idx, n, own as folded, '' as way from p union all {step.format("c.r, c.tree", "c1", "up", "s.tree = c.tree and")}),
  c2 as (select r, 0 as tree, 0 as lvl, c1.tree as idx, tops.n, folded, way from c1 join tops on tops.idx = c1.tree where c1.n = 1
    union all {step.format("c.r, c.tree", "c2", "above", "")})
  select p.doc_id, p.leaf, tops.h as subroot, (select h from above where n = 1) as root, sha256(c2.way) as proof_sha256, c2.folded as folded_root,
    c2.folded = (select h from above where n = 1) as verified
  from p join tops on tops.idx = p.tree join c2 on c2.r = p.r and c2.n = 1"""


SQL = {
    "op2_nearest_vectors": NEAREST,
    "op3_mix_sources": MIX,
    "op6_quality_rules": _rules_sql(),
    "op9_backoff_scores": BACKOFF,
    "op9_backoff_scores_order3": BACKOFF_ORDER3,
    "op11_ranked_search": _ranked_sql(),
    "op12_repeats": REPEATS,
    "op13_merkle_manifest": _merkle_sql(),
}
