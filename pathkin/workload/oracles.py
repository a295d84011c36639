"""The registered queries in SQL, written from the meaning of each operator.

Parse lines are never parsed here: what each line form must give is stated
outright, from the three words the line is built around.
"""

# Three words in a row of every text, with the place of the window.
_WINDOWS = r"""
texts as (select regexp_extract_all(text, '\p{{L}}+') as w from {table}),
places as (select w, unnest(generate_series(1, len(w) - 2)) as p from texts),
windows as (select p - 1 as i, w[p] as w1, w[p + 1] as w2, w[p + 2] as w3 from places)
"""
_DOCUMENT_WINDOWS = _WINDOWS.format(table="documents")

_LINES = (
    _DOCUMENT_WINDOWS
    + """,
lines as (select i % 8 as form, w1, w2, w3, case i % 8
  when 0 then w2 || chr(9) || w1 || '/NN/nsubj/2 ' || w2 || '/VBZ/ROOT/0 ' || w3 || '/NN/dobj/2' || chr(9) || '17'
  when 1 then w1 || '/NNP/nsubj/1' || chr(9) || w2 || '/VBZ/ROOT/0' || chr(9) || w3 || '/NNS/dobj/1'
  when 2 then w2 || chr(9) || w2 || '/VBZ/ROOT/0 ' || w1 || '/IN/prep/1 ' || w3 || '/NNP/pobj/2' || chr(9) || '153' || chr(9) || '1834,2'
  when 3 then w1 || '/NNP/nsubj/2' || chr(9) || w3 || '/VBZ/aux/2' || chr(9) || w2 || '/VBG/ROOT/0'
  when 4 then w1 || '/PRP/nsubj/1 ' || w2 || '/VBD/conj/3 ' || w3 || '/WP$/dobj/1 said/VBD/ROOT/0' || chr(9) || '1,204.5'
  when 5 then w2 || chr(9) || w2 || '/VB/ROOT/0 1/2/CD/num/1 ' || w3 || '/NN/dobj/1' || chr(9) || '5'
  when 6 then '  ' || chr(9) || w2 || chr(9) || w2 || '/VB/ROOT/0 ' || w3 || '/dt/dobj' || chr(9) || '5 '
  else w2 || '/NN/ROOT/0 ' || w1 || '/JJ/amod/1 ' || w3 || '/RB/advmod/-1' || chr(9) || '8'
  end as value from windows)
"""
)


def _stem(word: str) -> str:
    """SQL for the stem of a lower-case word."""
    ending = (
        f"(case when {word} like '%ing' and length({word}) > 4 then 3"
        f" when {word} like '%ed' and length({word}) > 3 then 2 else 0 end)"
    )
    body = f"left({word}, length({word}) - {ending})"
    return f"""case
  when {ending} > 0 then case
    when length({body}) >= 3 and right({body}, 1) = left(right({body}, 2), 1)
      and right({body}, 1) not in ('a', 'e', 'i', 'o', 'u') then left({body}, length({body}) - 1)
    when {word} like '%ying' then {body} || 'y'
    when {word} like '%ied' then left({body}, length({body}) - 1) || 'y'
    else {body} end
  when length({word}) <= 2 or {word} not like '%s' or right({word}, 2) in ('ss', 'us', 'is') then {word}
  when {word} like '%ies' then left({word}, length({word}) - 3) || 'y'
  when length({word}) > 3 and right({word}, 3) in ('ses', 'xes', 'zes', 'hes', 'oes')
    then left({word}, length({word}) - 2)
  else left({word}, length({word}) - 1) end"""


def _facts(table: str) -> str:
    """CTEs up to ``facts``: (path, slot, word, filler, prep, noun), one row per fact of a line."""
    return (
        _WINDOWS.format(table=table)
        + f""",
known as (select w, l, {_stem('l')} as s from
  (select w, lower(w) as l from (select distinct unnest(w) as w from texts))),
arcs as (
  select w2, w1 as word, 'nsubj' as rel, 0 as prep, i % 8 <> 4 as noun from windows
    where i % 8 in (0, 1, 3, 4)
  union all
  select w2, w3, 'dobj', 0, i % 8 not in (4, 6) from windows where i % 8 in (0, 1, 4, 5, 6)
  union all
  select w2, w3, w1, 1, true from windows where i % 8 = 2
  except all
  (select w2, w1, 'nsubj', 0, false from windows
    where i % 8 = 4 and lower(w2) in ('is', 'are', 'was', 'were', 'be', 'been', 'am')
  union all
  select w2, w3, 'dobj', 0, false from windows
    where i % 8 = 4 and lower(w2) in ('is', 'are', 'was', 'were', 'be', 'been', 'am'))
),
facts as (
  select v.s || ' -> ' || rel as path,
    case when lower(rel) like 'nsubj%' or lower(rel) in ('csubj', 'csubjpass') then 'X' else 'Y' end as slot,
    k.s as word, arcs.word as filler, prep, noun
  from arcs join known v on v.w = arcs.w2 join known k on k.w = arcs.word
)"""
    )


_SOLD = """
sold as (select l_orderkey, l_linenumber, l_quantity, p_brand || ' -> ' || p_type as path,
  l_returnflag as slot, cast(l_suppkey as varchar) as word
  from lineitem join part on l_partkey = p_partkey)"""
_TRIPLES = (
    _SOLD
    + """,
triples as (select path, slot, word, count(*) as cnt from sold group by all)"""
)
_MARGINALS = """
ps as (select path, slot, cast(sum(cnt) as bigint) as n from triples group by all),
sw as (select slot, word, cast(sum(cnt) as bigint) as n from triples group by all),
total as (select cast(sum(cnt) as bigint) as n from triples)"""
_MI = (
    _MARGINALS
    + """,
mi as (select path, slot, word,
  ln(cast(cnt as double) * (select n from total) / (cast(ps.n as double) * sw.n)) as mi
  from triples join ps using (path, slot) join sw using (slot, word))"""
)
_PAIRS = """
pairs as (select a.path as path_a, b.path as path_b, a.mi + b.mi as partial
  from mi a join mi b on a.slot = b.slot and a.word = b.word and a.path < b.path)"""
_SIMILARITY = (
    _PAIRS
    + """,
totals as (select path, sum(mi) as t from mi group by path),
sums as (select path_a, path_b, sum(partial) as num from pairs group by all),
similarity as (select path_a, path_b,
  case when ta.t + tb.t > 0 then num / (ta.t + tb.t) else num end as score
  from sums join totals ta on ta.path = path_a join totals tb on tb.path = path_b)"""
)
_SOLD_MI = f"with {_TRIPLES}, {_MI}"
_SOLD_SIMILARITY = f"{_SOLD_MI}, {_SIMILARITY}"
_FACT_TRIPLES = "triples as (select path, slot, word, count(*) as cnt from facts group by path, slot, word)"

_MI_ROWS = "select path, slot, word, round(mi, 6) as mi from mi"
_PAIR_SUMMARY = """select path_a, count(*) as n, round(sum(partial), 6) as partial_sum,
  round(min(partial), 6) as partial_min, round(max(partial), 6) as partial_max
  from pairs group by path_a"""

_STORED = """with stored as (select l_linenumber as k, 'part ' || l_partkey as path, l_returnflag as flag,
  cast(l_suppkey as varchar) as supplier, cast(l_quantity as bigint) as amount,
  cast(round(l_extendedprice * 100) as bigint) as cents,
  (l_orderkey * 100 + l_linenumber) * 100000000 + cast(round(l_extendedprice * 100) as bigint) as place
  from lineitem)"""

_GOLD = (
    _SOLD
    + """,
gold as (select a.path as path_a, b.path as path_b, min(b.l_orderkey * 100 + b.l_linenumber) as gold_row,
  cast(max(a.l_quantity) >= 40 as integer) as label
  from sold a join sold b on a.l_orderkey = b.l_orderkey and a.l_linenumber + 1 = b.l_linenumber
  group by a.path, b.path)"""
)
_SCORED_PAIRS = f"""with {_GOLD},
triples as (select path, slot, word, count(*) as cnt from sold group by path, slot, word),
{_MI}, {_SIMILARITY},
system as (select path_a, path_b, score from similarity
  union all select path_b, path_a, score / 2 from similarity),
keyed as (select least(path_a, path_b) as k1, greatest(path_a, path_b) as k2, score from system)"""
_BEST_SCORES = """,
best as (select k1, k2, max(score) as score from keyed group by all),
scored as (select gold_row, path_a, path_b, label, coalesce(score, 0.0) as score
  from gold left join best on k1 = least(path_a, path_b) and k2 = greatest(path_a, path_b))"""

_SCORED = """with scored as (select d.doc_id as gold_row, 'doc ' || d.doc_id as path_a, quality as label,
  floor(n_chars / 100.0) / 1000.0 as score from labels l join documents d on l.doc_id = d.doc_id)"""
_CURVE = (
    _SCORED
    + """,
steps as (select score, count(*) filter (label = 1) as pos, count(*) filter (label <> 1) as neg
  from scored group by score),
running as (select score, sum(pos) over (order by score desc) as tp, sum(neg) over (order by score desc) as fp,
  row_number() over (order by score) - 1 as position from steps),
curve as (select position, score as threshold, cast(tp as double) / (tp + fp) as precision,
  cast(tp as double) / (select sum(pos) from steps) as recall from running),
ended as (select position, threshold, precision, recall from curve
  union all select count(*), null, 1.0, 0.0 from curve),
rated as (select threshold, 2 * (precision * recall) / (precision + recall + 1e-10) as f1 from curve)"""
)
_CUTOFFS = (
    _SCORED
    + """,
middle as (select coalesce(median(score) filter (label = 1), 0.01) as m1,
  coalesce(median(score) filter (label <> 1), 0.001) as m0, avg(score) as mean, min(score) as lowest from scored),
cutoffs as (select case when m1 > m0 then m1 else greatest(0.01, mean + 1e-6) end as high,
  case when m1 > m0 then m0 else least(0.01, greatest(0.0, lowest)) end as low from middle)"""
)

_THRESHOLDS = """limits(threshold) as (values (0.0001), (0.001), (0.01), (0.05), (0.1)),
counts as (select cast(threshold as double) as threshold,
  count(*) filter (label = 1 and score >= threshold) as tp,
  count(*) filter (label <> 1 and score >= threshold) as fp,
  count(*) filter (label = 1 and score < threshold) as fn
  from scored cross join (select cast(threshold as double) as threshold from limits) group by threshold)"""
_MEASURED = """select threshold, tp, fp, fn,
  round(case when tp + fp > 0 then cast(tp as double) / (tp + fp) else 0.0 end, 6) as precision,
  round(case when tp + fn > 0 then cast(tp as double) / (tp + fn) else 0.0 end, 6) as recall,
  round(case when tp > 0 then 2.0 * tp / (2 * tp + fp + fn) else 0.0 end, 6) as f1
from counts"""
_STEPS = """steps2 as (select recall, precision, lead(recall) over (order by position) as r2, lead(precision) over (order by position) as p2 from ended)"""
_PLACES = """size as (select count(*) as m, least(count(*), 20) as k from curve),
places as (select case when j > 0 and j = k - 1 then m - 1 else cast(floor(j * (cast(m - 1 as double) / greatest(k - 1, 1))) as bigint) end as position
  from (select m, k, unnest(generate_series(0, k - 1)) as j from size))"""
_PLACED = """classed as (select 'TP' as class, scored.* from scored, cutoffs where label = 1 and score >= high
  union all select 'FP', scored.* from scored where label <> 1 and score > 0
  union all select 'TN', scored.* from scored, cutoffs where label <> 1 and score <= low
  union all select 'FN', scored.* from scored, cutoffs where label = 1 and score <= low),
placed as (select *, row_number() over (partition by class order by gold_row) as place from classed)"""


def _long(name: str, place: str, measures: list[str], rows: str) -> str:
    """Selects that turn the columns ``measures`` of ``rows`` into rows."""
    return " union all ".join(
        f"select '{name}' as \"table\", cast({place} as double) as place, '{m}' as measure,"
        f" round(cast({m} as double), 6) as value from {rows}"
        for m in measures
    )


_EVALUATION = f"""{_CURVE}{_CUTOFFS.removeprefix(_SCORED)}, {_THRESHOLDS}, {_STEPS}, {_PLACES}, {_PLACED},
measured as ({_MEASURED}),
area as (select sum((recall - r2) * (precision + p2) / 2) as auc from steps2),
best as (select threshold, f1 from rated order by f1 desc, threshold limit 1),
sampled as (select position, threshold, precision, recall from curve join places using (position))
""" + " union all ".join(
    [
        _long("scored", "gold_row", ["score"], "scored"),
        _long("threshold_metrics", "threshold", ["tp", "fp", "fn", "precision", "recall", "f1"], "measured"),
        _long("pr_curve", "position", ["threshold", "precision", "recall"], "ended"),
        _long("pr_auc", "0", ["auc"], "area"),
        _long("best_threshold", "0", ["threshold", "f1"], "best"),
        _long("sample_curve", "position", ["threshold", "precision", "recall"], "sampled"),
        _long("error_cutoffs", "0", ["high", "low"], "cutoffs"),
        """select 'error_samples', cast(gold_row as double), class, cast(place as double)
  from placed where place <= 5""",
    ]
)

ORACLES: dict[str, str] = {
    "ngram_segments": f"""with {_LINES},
cut as (select list_filter(list_transform(string_split(value, chr(9)), lambda s: trim(s)),
  lambda s: s <> '' and not regexp_full_match(s, '[0-9,]+[.]?[0-9]*')) as s from lines)
select cast(len(s) as integer) as n_segments, count(*) as n_lines,
  cast(sum(length(array_to_string(s, ''))) as bigint) as chars
from cut group by 1""",
    "ngram_tokens": f"""with {_DOCUMENT_WINDOWS},
parts(form, word_no, pos, dep, head, idx) as (values
  (0, 1, 'NN', 'nsubj', 2, 0), (0, 2, 'VBZ', 'ROOT', 0, 1), (0, 3, 'NN', 'dobj', 2, 2),
  (1, 1, 'NNP', 'nsubj', 1, 0), (1, 2, 'VBZ', 'ROOT', 0, 1), (1, 3, 'NNS', 'dobj', 1, 2),
  (2, 2, 'VBZ', 'ROOT', 0, 0), (2, 1, 'IN', 'prep', 1, 1), (2, 3, 'NNP', 'pobj', 2, 2),
  (3, 1, 'NNP', 'nsubj', 2, 0), (3, 3, 'VBZ', 'aux', 2, 1), (3, 2, 'VBG', 'ROOT', 0, 2),
  (4, 1, 'PRP', 'nsubj', 1, 0), (4, 2, 'VBD', 'conj', 3, 1), (4, 3, 'WP$', 'dobj', 1, 2), (4, 0, 'VBD', 'ROOT', 0, 3),
  (5, 2, 'VB', 'ROOT', 0, 0), (5, 3, 'NN', 'dobj', 1, 1),
  (6, 2, 'VB', 'ROOT', 0, 0), (6, 3, 'dt', 'dobj', 0, 1),
  (7, 2, 'NN', 'ROOT', 0, 0), (7, 1, 'JJ', 'amod', 1, 1), (7, 3, 'RB', 'advmod', -1, 2))
select case word_no when 0 then 'said' when 1 then w1 when 2 then w2 else w3 end as word,
  pos, dep, head, idx, count(*) as n
from windows join parts on form = i % 8 group by all""",
    "head_base": f"""with {_DOCUMENT_WINDOWS},
bases(form, base, linked) as (values (0, 1, 2), (1, 0, 2), (2, 1, 2), (3, 0, 2), (4, 0, 3), (5, 1, 1), (6, 0, 1), (7, 1, 1))
select base, count(*) as n_lines, cast(sum(linked) as bigint) as n_linked from windows join bases on form = i % 8 group by base""",
    "stem_words": rf"""with words as (select distinct unnest(regexp_extract_all(text, '\p{{L}}+')) as word from documents),
low as (select word, lower(word) as l from words)
select word, {_stem('l')} as stem from low""",
    "extract_direct": f"with {_facts('documents')} select path, slot, filler, count(*) as n from facts where prep = 0 group by all",
    "extract_prep": f"with {_facts('documents')} select path, slot, filler, count(*) as n from facts where prep = 1 group by all",
    "extract_nouns": f"with {_facts('documents')} select slot, word, count(*) as n from facts where noun group by all",
    "extraction_report": f"""with {_LINES}
select value, case when length(value) > 200 then left(value, 200) || '...' else value end as sample from lines
where form = 7 or (form = 4 and lower(w2) in ('is', 'are', 'was', 'were', 'be', 'been', 'am'))""",
    "split_path": """select p_partkey, case when p_size < 10 then p_name else p_name || ' -> ' || p_type end as path,
  case when p_size < 10 then '' when p_type in ('nsubj') then 'X' else 'Y' end as slot,
  case when p_size < 10 then '' else p_brand end as word from part""",
    "format_rule": "select p_partkey, 'X ' || p_name || ' Y' as rule from part",
    "triple_counts": f"with {_facts('documents')}, {_FACT_TRIPLES} select path, slot, word, cnt from triples",
    "marginals": f"""with {_TRIPLES}, {_MARGINALS}
select 'PS' as kind, path, slot, '' as word, n from ps
union all select 'SW', '', slot, word, n from sw
union all select 'TOTAL', '', '', '', n from total""",
    "path_slot_counts": f"with {_SOLD} select path, slot, count(*) as n from sold group by all",
    "slot_word_counts": f"with {_SOLD} select slot, word, count(*) as n from sold group by all",
    "total_count": f"with {_SOLD} select count(*) as n from sold",
    "mutual_information": f"{_SOLD_MI} {_MI_ROWS}",
    "mutual_information_stored": f"{_SOLD_MI} {_MI_ROWS}",
    "mutual_information_repeated": f"""with {_SOLD},
triples as (select path, slot, word, cast(l_quantity as bigint) as cnt from sold), {_MI}
select path, slot, word, round(max(mi), 6) as mi from mi group by all""",
    "mutual_information_text": f"with {_facts('documents')}, {_FACT_TRIPLES}, {_MI} {_MI_ROWS}",
    "path_totals": f"{_SOLD_MI} select path, round(sum(mi), 6) as total_mi from mi group by path",
    "feature_pairs": f"{_SOLD_MI}, {_PAIRS} {_PAIR_SUMMARY}",
    "feature_pairs_blocked": f"{_SOLD_MI}, {_PAIRS} {_PAIR_SUMMARY}",
    "pair_numerators": f"{_SOLD_SIMILARITY} select path_a, path_b, round(num, 6) as score from sums",
    "path_similarity": f"{_SOLD_SIMILARITY} select path_a, path_b, round(score, 6) as score from similarity",
    "lin_normalize": f"""{_SOLD_SIMILARITY},
known as (select path, t from totals where t > 5)
select path_a, path_b, round(case when ta.t + tb.t > 0 then num / (ta.t + tb.t) else num end, 6) as score
from sums left join known ta on ta.path = path_a left join known tb on tb.path = path_b""",
    "discover_rules": f"""with {_facts('conversations')}, {_FACT_TRIPLES}, {_MI}, {_SIMILARITY}
select path_a, count(*) as n, round(sum(score), 4) as score_sum, round(max(score), 6) as score_max
from similarity group by path_a""",
    "similarity_stats": f"""{_SOLD_SIMILARITY}
select 'triples' as stage, count(*) as n_rows from triples
union all select 'mi', count(*) from mi union all select 'similarity', count(*) from similarity""",
    "parse_triples": f"{_STORED} select path, flag as slot, supplier as word, amount as cnt from stored where k in (2, 4, 6, 7)",
    "parse_mi": f"""{_STORED} select path, flag as slot, supplier as word,
  case k when 2 then -cents / 100.0 when 4 then cast(cents as double) else cents / 100.0 end as mi
  from stored where k in (2, 4, 6, 7)""",
    "parse_partials": f"""{_STORED} select path as path_a, supplier as path_b,
  case k when 2 then -cents / 100.0 when 3 then cast('.' || cents as double) else cents / 100.0 end as partial
  from stored where k in (2, 3, 5, 6, 7)""",
    "parse_totals": f"""{_STORED} select path, arg_max(case k when 2 then -cents / 100.0 else cents / 100.0 end, place) as total_mi
  from stored where k in (2, 5, 6, 7) group by path""",
    "parse_marginals": f"""{_STORED}
select 'PS' as kind, path, flag as slot, '' as word, amount as n from stored where k in (5, 6, 7)
union all select 'SW', '', flag, supplier, amount from stored where k = 1
union all select 'TOTAL', '', '', '', amount from stored where k = 2""",
    "parse_system": f"""{_STORED} select path as path_a, supplier as path_b,
  case k when 1 then cast(cents as double) when 2 then 0.0 when 4 then 0.0 else cents / 100.0 end as score
  from stored""",
    "parse_system_ws": f"""{_STORED} select supplier as path_a, case k when 4 then flag else path end as path_b,
  case when k in (3, 4) then cast(cents as double) else cents / 100.0 end as score
  from stored where k not in (1, 2)""",
    "marginal_lines": f"""with {_TRIPLES}, {_MARGINALS}
select 'PS:' || path || chr(9) || slot || chr(9) || n as value from ps
union all select 'SW:' || slot || chr(9) || word || chr(9) || n from sw
union all select 'TOTAL' || chr(9) || n from total""",
    "read_gold": f"with {_GOLD} select path_a, path_b, label from gold",
    "score_gold": f"""{_SCORED_PAIRS}{_BEST_SCORES}
select gold_row, path_a, path_b, label, round(score, 6) as score from scored""",
    "score_gold_dups": f"""{_SCORED_PAIRS}
select gold_row, path_a, path_b, label, round(coalesce(score, 0.0), 6) as score
from gold left join keyed on k1 = least(path_a, path_b) and k2 = greatest(path_a, path_b)""",
    "score_gold_direct": f"""{_SCORED_PAIRS}
select gold_row, g.path_a, g.path_b, label, round(coalesce(score, 0.0), 6) as score
from gold g left join similarity s
  on s.path_a = least(g.path_a, g.path_b) and s.path_b = greatest(g.path_a, g.path_b)""",
    "evaluate_rules": _EVALUATION,
    "gold_unmatched": f"""{_SCORED_PAIRS}{_BEST_SCORES},
hits as (select least(path_a, path_b) as k1, greatest(path_a, path_b) as k2 from scored where label = 0 and score > 0)
select gold_row, path_a, path_b, label from scored where label = 0 and not exists
  (select 1 from hits where k1 = least(path_a, path_b) and k2 = greatest(path_a, path_b))""",
    "threshold_metrics": f"""{_SCORED},
{_THRESHOLDS}
{_MEASURED}""",
    "pr_curve": f"{_CURVE} select position, threshold, round(precision, 6) as precision, round(recall, 6) as recall from ended",
    "pr_auc": f"""{_CURVE},
{_STEPS}
select round(sum((recall - r2) * (precision + p2) / 2), 6) as auc from steps2""",
    "curve_f1": f"{_CURVE} select threshold, round(f1, 6) as f1 from rated",
    "best_threshold": f"{_CURVE} select threshold, round(f1, 6) as f1 from rated order by rated.f1 desc, threshold limit 1",
    "sample_curve": f"""{_CURVE},
{_PLACES}
select position, threshold, round(precision, 6) as precision, round(recall, 6) as recall
from curve join places using (position)""",
    "error_cutoffs": f"{_CUTOFFS} select round(high, 6) as high, round(low, 6) as low from cutoffs",
    "error_samples": f"""{_CUTOFFS},
{_PLACED}
select class, cast(place as integer) as place, gold_row, path_a, label, score from placed where place <= 5""",
}
