"""Blocking, pairs, scores, clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import STEPS, query
from checks.gap import gap_distances
from reclink.operators import blocking as B
from reclink.operators import clusters as C
from reclink.operators import committee as M
from reclink.operators import pairs as P
from reclink.operators import retrieval as R
from reclink.operators import training as L
from reclink.plans.arrivals import run_arrivals, stored_links
from reclink.plans.labelling import next_questions, stored_committee, take_answers
from reclink.plans.resolution import link_pipeline, link_records
from reclink.schemas import CLUSTER_THRESHOLD, ENTITY_MAP, IDENTITY, TRAINING_RECALL
from reclink.session import cut, scratch
from reclink.sources.store import Store

RULES = (*B.EMPLOYER_RULES, B.Rule("rare", (B.Part("name", "rare", 4), B.Part("country"))))
SIMILARITY = P.least_name_similarity()


def words(x: str) -> str:
    return f"list_distinct(regexp_split_to_array(lower(trim({x})), '\\s+'))"


STEPS["rare_words"] = """
select token, count(*) as df from (select unnest(list_distinct(regexp_split_to_array(value, '\\s+'))) as token
  from (select distinct lower(trim(name)) as value from {employers} where trim(name) != '') v) w
group by token having count(*) <= 4
"""
STEPS["blocks"] = f"""
select distinct block_key, id from (
  select 'phone:' || lower(trim(phone)) || '|' || substr(lower(trim(name)), 1, 1) as block_key, id from {{employers}}
  where phone != ''
  union all
  select 'words:' || array_to_string(list_sort({words('name')}), ' ') || '|' || lower(state), id from {{employers}}
  union all
  select 'start:' || substr(lower(name), 1, 6) || '|' || lower(city) || '|' || lower(state), id from {{employers}}
  union all
  select 'trade:' || array_to_string(list_sort({words('trade_name_dba')}), ' ') || '|' || substr(lower(name), 1, 3)
    || '|' || lower(state), id from {{employers}} where trim(trade_name_dba) != ''
  union all
  select 'rare:' || e.token || '|' || lower(e.country), e.id
  from (select id, country, unnest({words('name')}) as token from {{employers}}) e
  join {{rare_words}} r on r.token = e.token
) b where block_key is not null
"""
STEPS["block_sizes"] = "select block_key, count(*) as n from {blocks} group by block_key"
REACH = (
    f"levenshtein(lower(trim(a.name)), lower(trim(b.name))) <= "
    f"floor((1.0 - {SIMILARITY!r}::double) * greatest(length(trim(a.name)), length(trim(b.name))) + 1e-9)"
)
STEPS["candidates"] = f"""
select distinct p.left_id, p.right_id
from (select distinct x.id as left_id, y.id as right_id from {{blocks}} x
  join {{blocks}} y on x.block_key = y.block_key and x.id < y.id) p
join {{employers}} a on a.id = p.left_id join {{employers}} b on b.id = p.right_id
where {REACH}
"""


def cell(side: str, f: str) -> str:
    return f"nullif(lower(trim({side}.{f})), '')"


def ratio(f: str) -> str:
    a, b = cell("a", f), cell("b", f)
    return f"coalesce(1 - levenshtein({a}, {b}) / greatest(length({a}), length({b}))::double, 0.0)"


def equal(f: str) -> str:
    return f"case when {cell('a', f)} = {cell('b', f)} then 1.0 else 0.0 end"


def missing(f: str) -> str:
    return f"case when {cell('a', f)} is null or {cell('b', f)} is null then 1.0 else 0.0 end"


STEPS["vectors"] = f"""
select p.left_id, p.right_id, {ratio('name')} as name_sim,
  len(list_intersect({words('a.name')}, {words('b.name')}))::double
    / len(list_distinct(list_concat({words('a.name')}, {words('b.name')}))) as name_jaccard,
  {ratio('trade_name_dba')} as trade_sim, {missing('trade_name_dba')} as trade_missing,
  {equal('city')} as city_eq, {equal('state')} as state_eq, {equal('country')} as country_eq,
  {missing('country')} as country_missing, {equal('phone')} as phone_eq
from {{candidates}} p join {{employers}} a on a.id = p.left_id join {{employers}} b on b.id = p.right_id
"""
TOTAL = " + ".join(f"{w} * {f}" if f != "bias" else f"({w})" for f, w in P.DEFAULT_WEIGHTS.items())
STEPS["scored"] = f"select *, 1 / (1 + exp(-({TOTAL}))) as score from {{vectors}}"
VECTOR = ", ".join(f"round({f}, 6) as {f}" for f in P.FEATURES)

# Pairs for a person, who is asked about lower scores too.
STEPS["doubt_candidates"] = STEPS["candidates"].replace(repr(SIMILARITY), repr(P.least_name_similarity(threshold=L.LABEL_FLOOR)))
STEPS["doubt_vectors"] = STEPS["vectors"].replace("{candidates}", "{doubt_candidates}")
STEPS["doubt_scored"] = STEPS["scored"].replace("{vectors}", "{doubt_vectors}")


def blocks(t):
    return B.block_keys(t("employers"), RULES)


def candidates(t, max_block: int = P.MAX_BLOCK):
    return P.candidate_pairs(blocks(t), t("employers"), max_block=max_block)


def vectors(t):
    return P.compare_pairs(P.pair_records(candidates(t), t("employers")))


def scored(t):
    return P.score_pairs(vectors(t))


def strong(t):
    """The scored pairs of which links are made: candidates that cannot reach the threshold are left out. Written once."""
    pairs = P.candidate_pairs(blocks(t), t("employers"), bound=P.Bound())
    found = P.score_pairs(P.compare_pairs(P.pair_records(pairs, t("employers")))).select("left_id", "right_id", "score")
    return cut(found.where(F.col("score") > CLUSTER_THRESHOLD), "strong")


@query(
    "field_values",
    " union ".join(f"select '{f}' as field, {f} as value from {{employers}} where {f} is not null" for f in IDENTITY),
)
def field_values(t):
    return B.field_values(t("employers"), IDENTITY)


STEPS["word_sets"] = f"""
select distinct array_to_string(list_sort({words('name')}), ' ') as words from {{employers}} where trim(name) != ''
"""
STEPS["set_tokens"] = "select words, unnest(string_split(words, ' ')) as token from {word_sets}"
STEPS["token_weights"] = """
select words, token, raw / sqrt(sum(raw * raw) over (partition by words)) as weight from (
  select s.words, s.token, ln(1 + (select count(*) from {word_sets})::double / d.df) as raw from {set_tokens} s
  join (select token, count(*) as df from {set_tokens} group by token) d on d.token = s.token) x
"""
# All pairs of sets with a common word.
STEPS["cosine_pairs"] = f"""
select a.words as left_words, b.words as right_words, sum(a.weight * b.weight) as cosine
from {{token_weights}} a join {{token_weights}} b on a.token = b.token and a.words < b.words
group by 1, 2 having sum(a.weight * b.weight) >= {R.LEAST_COSINE}
"""
STEPS["cosine_blocks"] = f"""
with named as (select id, array_to_string(list_sort({words('name')}), ' ') as words from {{employers}} where trim(name) != '')
select 'cosine:' || words as block_key, id from named
union all
select 'cosine:' || p.left_words || '|' || p.right_words, n.id from {{cosine_pairs}} p
join named n on n.words in (p.left_words, p.right_words)
"""


@query("token_weights", "select words, token, round(weight, 6) as weight from {token_weights}")
def token_weights(t):
    return R.token_weights(t("employers"), "name")


@query("cosine_pairs", "select left_words, right_words, round(cosine, 6) as cosine from {cosine_pairs}")
def cosine_pairs(t):
    return R.cosine_pairs(t("employers"), "name")


@query("cosine_blocks", "select block_key, id from {cosine_blocks}")
def cosine_blocks(t):
    return R.cosine_blocks(t("employers"), "name")


@query(
    "candidate_pairs_cosine",
    "select distinct x.id as left_id, y.id as right_id from {cosine_blocks} x join {cosine_blocks} y "
    "on x.block_key = y.block_key and x.id < y.id join {employers} a on a.id = x.id join {employers} b on b.id = y.id "
    f"where {REACH}",
)
def candidate_pairs_cosine(t):
    return P.candidate_pairs(R.cosine_blocks(t("employers"), "name"), t("employers"))


@query("token_index", "select token, df from {rare_words}")
def token_index(t):
    return B.token_index(t("employers"), "name", 4)


@query(
    "token_index_documents",
    "select token, count(*) as df from (select unnest(list_distinct(regexp_split_to_array(value, '\\s+'))) as token "
    "from (select distinct lower(trim(text)) as value from {documents}) v where value != '') w "
    "group by token having count(*) <= 20",
)
def token_index_documents(t):
    return B.token_index(t("documents"), "text", 20)


@query("block_keys", "select block_key, id from {blocks}")
def block_keys(t):
    return blocks(t)


# The code of each letter from a to z; 7 stands for letters that are passed over.
SOUNDEX_CODES = "01230127022455012623017202"
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def soundex_sql(text: str) -> str:
    """Soundex by translation: codes without the passed letters, runs shortened, the first letter's code and zeros left out."""
    codes = f"regexp_replace(translate({text}, '{LETTERS}', '{SOUNDEX_CODES}'), '[^0-9]', '0', 'g')"
    codes = f"(left({codes}, 1) || replace(substr({codes}, 2), '7', ''))"
    for digit in "0123456":
        codes = f"regexp_replace({codes}, '{digit}+', '{digit}', 'g')"
    return f"upper(left({text}, 1)) || left(replace(substr({codes}, 2), '0', '') || '000', 3)"


# Names without a first letter are their own code; digits in names are no letters.
STEPS["sound_names"] = """
select id, regexp_replace(lower(trim(name)), '[0-9]', '-', 'g') as text, lower(trim(name)) as plain, right(lower(trim(phone)), 4) as tail
from {employers} where trim(name) != '' and trim(phone) != ''
"""


@query(
    "block_keys_soundex",
    f"select 'sound:' || case when regexp_matches(text, '^[a-z]') then {soundex_sql('text')} else plain end || '|' || tail "
    "as block_key, id from {sound_names}",
)
def block_keys_soundex(t):
    return B.block_keys(t("employers"), (B.Rule("sound", (B.Part("name", "soundex"), B.Part("phone", "tail", 4))),))


@query(
    "block_stats",
    "select block_key, n as n_records, n * (n - 1) // 2 as n_pairs, n > 8 as oversized from {block_sizes}",
)
def block_stats(t):
    return B.block_stats(blocks(t), 8)


@query(
    "cap_blocks",
    "select b.block_key, b.id, s.n > 8 as oversized from {blocks} b join {block_sizes} s on s.block_key = b.block_key",
)
def cap_blocks(t):
    return B.cap_blocks(blocks(t), 8)


@query("candidate_pairs", "select left_id, right_id from {candidates}")
def candidate_pairs(t):
    return candidates(t)


@query("candidate_pairs_large_blocks", "select left_id, right_id from {candidates}")
def candidate_pairs_large_blocks(t):
    # Blocks of three records and more take the way of large blocks; the pairs are the same.
    return candidates(t, max_block=2)


PAIR_FIELDS = ", ".join(f"a.{f} as left_{f}" for f in IDENTITY) + ", " + ", ".join(f"b.{f} as right_{f}" for f in IDENTITY)


@query(
    "pair_records",
    f"select p.left_id, p.right_id, {PAIR_FIELDS} from {{candidates}} p "
    "join {employers} a on a.id = p.left_id join {employers} b on b.id = p.right_id",
)
def pair_records(t):
    return P.pair_records(candidates(t), t("employers"))


@query("compare_pairs", f"select left_id, right_id, {VECTOR} from {{vectors}}")
def compare_pairs(t):
    return vectors(t)


STEPS["candidate_names"] = f"""
select p.left_id, p.right_id, least({cell('a', 'name')}, {cell('b', 'name')}) as a, greatest({cell('a', 'name')}, {cell('b', 'name')}) as b
from {{candidates}} p join {{employers}} a on a.id = p.left_id join {{employers}} b on b.id = p.right_id
"""
STEPS["candidate_gaps"] = gap_distances("{candidate_names}")


@query(
    "compare_pairs_gap",
    f"select v.left_id, v.right_id, {VECTOR}, round(g.distance, 6) as name_gap from {{vectors}} v "
    "join {candidate_names} n on n.left_id = v.left_id and n.right_id = v.right_id "
    "left join {candidate_gaps} g on g.a = n.a and g.b = n.b",
)
def compare_pairs_gap(t):
    return P.compare_pairs(P.pair_records(candidates(t), t("employers")), gap=True)


@query("score_pairs", "select left_id, right_id, round(score, 6) as score from {scored}")
def score_pairs(t):
    return scored(t).select("left_id", "right_id", "score")


@query("training_sample", "select id, name from {employers} order by name, id limit 10000")
def training_sample(t):
    return L.training_sample(t("employers")).select("id", "name")


@query(
    "label_queue",
    "select left_id, right_id, round(score, 6) as score from {doubt_scored} s where not exists (select 1 from {labels_true} l "
    "where l.left_id = s.left_id and l.right_id = s.right_id) order by abs(s.score - 0.5), left_id, right_id limit 50",
)
def label_queue(t):
    pairs = L.label_candidates(blocks(t), t("employers"))
    doubtful = P.score_pairs(P.compare_pairs(P.pair_records(pairs, t("employers"))))
    return L.label_queue(doubtful.select("left_id", "right_id", "score"), t("labels_true"), 50)


def labelled_vectors(t):
    return P.compare_pairs(P.pair_records(t("pair_labels").select("left_id", "right_id"), t("employers")))


@query("train_pair_model")
def train_pair_model(t):
    _, weights = L.train_pair_model(labelled_vectors(t), t("pair_labels"))
    return weights


# A committee of which one member doubts the starting weights and one is surer of them.
STANCES = (0.5, 1.0, 1.5)


def stance_score(stance: float) -> str:
    total = " + ".join(f"{w * stance!r} * {f}" if f != "bias" else f"({w * stance!r})" for f, w in P.DEFAULT_WEIGHTS.items())
    return f"1 / (1 + exp(-({total})))"


STEPS["stances"] = f"""
select min(struct_pack(l := left_id, r := right_id)) as pair, count(*) as n_alike, {', '.join(P.FEATURES)},
  [{', '.join(stance_score(k) for k in STANCES)}] as scores
from {{doubt_vectors}} v
where not exists (select 1 from {{labels_true}} l where l.left_id = v.left_id and l.right_id = v.right_id)
group by {', '.join(P.FEATURES)}
"""
STEPS["doubts"] = """
select pair.l as left_id, pair.r as right_id, n_alike, list_avg(scores) as score, list_var_pop(scores) as disagreement from {stances}
"""


@query(
    "committee_queue",
    "select left_id, right_id, n_alike, round(score, 6) as score, round(disagreement, 6) as disagreement from {doubts} "
    "order by round(n_alike * disagreement, 9) desc, left_id, right_id limit 20",
)
def committee_queue(t):
    pairs = L.label_candidates(blocks(t), t("employers"))
    members = [(i, f, w * stance) for i, stance in enumerate(STANCES) for f, w in P.DEFAULT_WEIGHTS.items()]
    committee = t.spark.createDataFrame(members, M.COMMITTEE)
    return M.committee_queue(P.compare_pairs(P.pair_records(pairs, t("employers"))), committee, t("labels_true"), 20)


@query(
    "label_weights",
    "select left_id, right_id, member, round(-ln((('0x' || substr(md5(member || ':' || left_id || ':' || right_id), 1, 13))::bigint "
    f"+ 0.5) / {1 << 52}), 6) as weight from {{pair_labels}}, (select unnest(range(0, {M.MEMBERS}))::int as member) m",
)
def label_weights(t):
    return M.label_weights(t("pair_labels"))


@query("label_loop")
def label_loop(t):
    store = Store(t.spark, scratch(t.spark, "sittings"))
    vectors = cut(labelled_vectors(t), "pool")
    for _ in range(2):
        asked = next_questions(store, vectors, 20).select("left_id", "right_id")
        take_answers(store, vectors, asked.join(t("pair_labels"), ["left_id", "right_id"]))
    return stored_committee(store)


@query(
    "rule_coverage",
    "select left_id, right_id, coalesce(array_to_string(list_sort(list_distinct(list(rule))), ','), '') as rules from ("
    "select l.left_id, l.right_id, split_part(x.block_key, ':', 1) as rule from {labels_true} l "
    "left join (select a.id as left_id, b.id as right_id, a.block_key from {blocks} a "
    "join {blocks} b on a.block_key = b.block_key) x on x.left_id = l.left_id and x.right_id = l.right_id) y group by 1, 2",
)
def rule_coverage(t):
    return L.rule_coverage(t("employers"), t("labels_true"), RULES)


@query(
    "rule_costs",
    "select split_part(block_key, ':', 1) as rule, cast(sum(n * (n - 1) // 2) as bigint) as n_pairs from {block_sizes} group by 1",
)
def rule_costs(t):
    return L.rule_costs(t("employers"), RULES)


# The greedy choice, one step after the other.
STEPS["patterns"] = """
select rules, count(*) as n from (
  select left_id, right_id, list_distinct(list(rule)) as rules from (
    select l.left_id, l.right_id, split_part(x.block_key, ':', 1) as rule from {labels_true} l
    left join (select a.id as left_id, b.id as right_id, a.block_key from {blocks} a
      join {blocks} b on a.block_key = b.block_key) x on x.left_id = l.left_id and x.right_id = l.right_id) y
  group by 1, 2) z group by 1
"""
STEPS["costs"] = """
select split_part(block_key, ':', 1) as rule, cast(sum(n * (n - 1) // 2) as bigint) as n_pairs from {block_sizes} group by 1
"""
STEPS["picked_0"] = """
select 0 as step, '' as rule, cast(0 as bigint) as newly_covered, cast(0 as bigint) as n_pairs, cast([] as varchar[]) as chosen,
  cast(0 as bigint) as covered, cast((select sum(n) from {patterns}) as bigint) as total
"""
for _step in range(1, len(RULES) + 1):
    STEPS[f"picked_{_step}"] = f"""
select {_step} as step, rule, gain as newly_covered, n_pairs, list_append(chosen, rule) as chosen, covered + gain as covered, total
from (select r.rule, coalesce(c.n_pairs, 0) as n_pairs, p.chosen, p.covered, p.total, cast((select coalesce(sum(t.n), 0)
    from {{patterns}} t where list_contains(t.rules, r.rule) and not list_has_any(t.rules, p.chosen)) as bigint) as gain
  from {{picked_{_step - 1}}} p cross join (select unnest([{", ".join(f"'{r.name}'" for r in RULES)}]) as rule) r
  left join {{costs}} c on c.rule = r.rule
  where not list_contains(p.chosen, r.rule) and p.covered < {TRAINING_RECALL} * p.total) x
where gain > 0 qualify row_number() over (order by gain / (n_pairs + 1) desc, gain desc, rule desc) = 1
"""


@query(
    "choose_block_rules",
    " union all ".join(
        f"select step, rule, newly_covered, round(covered / total, 6) as recall, n_pairs from {{picked_{i}}}"
        for i in range(1, len(RULES) + 1)
    ),
)
def choose_block_rules(t):
    return L.choose_block_rules(t("employers"), t("labels_true"), RULES)


# The search for conjunctions of parts, one level after the other.
def part_sql(p: B.Part) -> str:
    text = f"lower(trim({p.field}))"
    key = {"whole": text, "prefix": f"substr({text}, 1, {p.size})", "tokens": f"array_to_string(list_sort({words(p.field)}), ' ')"}
    return f"select id, {{number}} as p, {key[p.kind]} as k from {{{{employers}}}} where {text} != ''"


STEPS["rule_parts"] = " union all ".join(part_sql(p).format(number=i) for i, p in enumerate(L.RULE_PARTS))
STEPS["part_names"] = "select * from (values " + ", ".join(f"({i}, '{L.part_name(p)}')" for i, p in enumerate(L.RULE_PARTS)) + ") v(p, name)"
STEPS["agreed"] = """
select l.left_id, l.right_id, a.p from {labels_true} l join {rule_parts} a on a.id = l.left_id
join {rule_parts} b on b.id = l.right_id and b.p = a.p and b.k = a.k
"""
# Two of them are beginnings of one field.
NESTED = [(i, j) for i, a in enumerate(L.RULE_PARTS) for j, b in enumerate(L.RULE_PARTS) if i < j and L._nested([a, b])]
BOUND = f"{L.PAIRS_PER_RECORD} * (select count(*) from {{employers}})"


def level_sql(combos: str, size: int) -> str:
    """Names, matches and pairs of combinations p1, p2, ... of parts."""
    at = range(1, size + 1)
    ps, ks = ", ".join(f"c.p{i}" for i in at), ", ".join(f"x{i}.k" for i in at)
    same = " and ".join(f"c.p{i} = o.p{i}" for i in at)
    keyed = " ".join(f"join {{rule_parts}} x{i} on x{i}.p = c.p{i}" + (" and x1.id = x%d.id" % i if i > 1 else "") for i in at)
    met = " ".join(
        f"join {{agreed}} a{i} on a{i}.p = c.p{i}"
        + (f" and a{i}.left_id = a1.left_id and a{i}.right_id = a1.right_id" if i > 1 else "")
        for i in at
    )
    names = " || '&' || ".join(f"n{i}.name" for i in at)
    named = " ".join(f"join {{part_names}} n{i} on n{i}.p = c.p{i}" for i in at)
    grouped = ps.replace("c.", "")
    return f"""
select {ps}, {names} as rule, coalesce(m.covered, 0) as covered, coalesce(o.n_pairs, 0) as n_pairs from {combos} c {named}
left join (select {grouped}, cast(sum(n * (n - 1) // 2) as bigint) as n_pairs
  from (select {ps}, {ks}, count(*) as n from {combos} c {keyed} group by {ps}, {ks}) z group by {grouped}) o on {same}
left join (select {ps}, count(*) as covered from {combos} c {met} group by {ps}) m on {same.replace("o.", "m.")}
"""


STEPS["combos_1"] = "select p as p1 from {part_names}"
STEPS["searched_1"] = level_sql("{combos_1}", 1)
STEPS["combos_2"] = f"""
select a.p1, b.p1 as p2 from {{searched_1}} a join {{searched_1}} b on a.p1 < b.p1
where least(a.covered, b.covered) > 0 and least(a.n_pairs, b.n_pairs) > {BOUND}
  and (a.p1, b.p1) not in ({", ".join(map(str, NESTED))})
"""
STEPS["searched_2"] = level_sql("{combos_2}", 2)
STEPS["combos_3"] = f"""
select a.p1, a.p2, b.p2 as p3 from (select * from {{searched_2}} where covered > 0 and n_pairs > {BOUND}) a
join (select * from {{searched_2}} where covered > 0 and n_pairs > {BOUND}) b on a.p1 = b.p1 and a.p2 < b.p2
join (select * from {{searched_2}} where covered > 0 and n_pairs > {BOUND}) c on c.p1 = a.p2 and c.p2 = b.p2
"""
STEPS["searched_3"] = level_sql("{combos_3}", 3)
STEPS["searched"] = " union all ".join(
    f"select rule, {i} as n_parts, covered, n_pairs, covered > 0 and n_pairs <= {BOUND} as admitted from {{searched_{i}}}" for i in (1, 2, 3)
)


@query("search_rules", "select rule, n_parts, covered, n_pairs, admitted from {searched}")
def search_rules(t):
    found, _ = L.search_rules(t("employers"), t("labels_true"))
    rows = [(f.rule.name, len(f.rule.parts), f.covered, f.n_pairs, f.admitted) for f in found]
    return t.spark.createDataFrame(rows, "rule string, n_parts int, covered bigint, n_pairs bigint, admitted boolean")


@query("learn_block_rules")
def learn_block_rules(t):
    return L.learn_block_rules(t("employers"), t("labels_true"))[1]


HIT = f"coalesce(s.score > {CLUSTER_THRESHOLD}, false)"
STEPS["quality"] = f"""
select count(*) filter (where {HIT} and is_match) as tp, count(*) filter (where {HIT} and not is_match) as fp,
  count(*) filter (where not {HIT} and is_match) as fn
from {{pair_labels}} l left join {{scored}} s on s.left_id = l.left_id and s.right_id = l.right_id
"""


@query(
    "pair_quality",
    "select tp as true_positive, fp as false_positive, fn as false_negative, round(tp / (tp + fp), 6) as precision, "
    "round(tp / (tp + fn), 6) as recall, round(2 * tp / (2 * tp + fp + fn), 6) as f1 from {quality}",
)
def pair_quality(t):
    return P.pair_quality(scored(t), t("pair_labels"))


STEPS["links"] = f"select left_id, right_id, score from {{scored}} where score > {CLUSTER_THRESHOLD}"
# Smallest id that a record reaches; full closure, fine for small components.
STEPS["ends"] = "select left_id as a, right_id as b, score from {links} union all select right_id, left_id, score from {links}"
CLOSURE = """
with recursive reach(id, other) as (
  select a, b from ends union select r.id, e.b from reach r join ends e on e.a = r.other
) select id, least(id, min(other)) as canon_id from reach group by id
"""
STEPS["clusters"] = "select * from (" + CLOSURE.replace("ends", "{ends}") + ") z"
STEPS["member_scores"] = """
select c.id as employer_record_id, c.canon_id, s.score as cluster_score
from {clusters} c join (select a, avg(score) as score from {ends} group by a) s on s.a = c.id
"""
SCORES = "employer_record_id, canon_id, round(cluster_score, 6) as cluster_score"


@query("cluster_pairs", "select id, canon_id from {clusters}")
def cluster_pairs(t):
    return C.cluster_pairs(strong(t))


@query("cluster_scores", f"select {SCORES} from {{member_scores}}")
def cluster_scores(t):
    pairs = strong(t)
    return C.cluster_scores(C.cluster_pairs(pairs), pairs)


def entity_rows(t):
    return t("entity_map").select(*ENTITY_MAP.names)


@query(
    "build_entity_map",
    "select coalesce(s.employer_record_id, m.employer_record_id) as employer_record_id, "
    "coalesce(s.canon_id, m.canon_id) as canon_id, round(coalesce(s.cluster_score, m.cluster_score), 6) as cluster_score, "
    "m.is_valid_cluster, cast(cast(m.review_date as date) as varchar) as review_date, "
    "case when m.employer_record_id is null then false else m.processed end as processed "
    "from {member_scores} s full join {entity_map} m on m.employer_record_id = s.employer_record_id",
)
def build_entity_map(t):
    pairs = strong(t)
    return C.build_entity_map(C.cluster_scores(C.cluster_pairs(pairs), pairs), entity_rows(t))


@query("link_records", f"select {SCORES} from {{member_scores}}")
def link_records_query(t):
    return link_records(t("employers"), RULES)


@query(
    "link_pipeline",
    f"select {SCORES}, cast(null as boolean) as is_valid_cluster, cast(null as varchar) as review_date, "
    "false as processed from {member_scores}",
)
def link_pipeline_query(t):
    return link_pipeline(t("employers"), entity_rows(t), refresh=True, rules=RULES)


# Average linkage: each step merges, in every component, the two clusters of the highest mean score.
STEPS["average_clusters"] = f"""
with recursive steps(step, id, part, comp) as (
  select 0, id, id, canon_id from {{clusters}}
  union all
  select s.step + 1, s.id, case when s.part = b.high then b.low else s.part end, s.comp
  from steps s join (
    select comp, low, high from (
      select w.comp, w.low, w.high, round(w.total / (x.n * y.n), 9) as mean from (
        select l.comp, least(l.part, r.part) as low, greatest(l.part, r.part) as high, sum(e.score) as total
        from {{links}} e join steps l on l.id = e.left_id join steps r on r.id = e.right_id
        where l.part != r.part group by 1, 2, 3) w
      join (select part, count(*) as n from steps group by part) x on x.part = w.low
      join (select part, count(*) as n from steps group by part) y on y.part = w.high) z
    where mean > {CLUSTER_THRESHOLD}
    qualify row_number() over (partition by comp order by mean desc, low, high) = 1) b on b.comp = s.comp
)
select id, arg_max(part, step) as canon_id from steps group by id
"""


@query("average_linkage", "select id, canon_id from {average_clusters}")
def average_linkage(t):
    return C.average_linkage(strong(t))


# Rules without rare words, whose blocks do not change as records arrive.
PLAIN = ["candidates", "vectors", "scored", "links", "ends", "clusters", "member_scores"]
STEPS["plain_blocks"] = "select * from {blocks} where block_key not like 'rare:%'"
for _name in PLAIN:
    _text = STEPS[_name]
    for _other in ["blocks", *PLAIN]:
        _text = _text.replace(f"{{{_other}}}", f"{{plain_{_other}}}")
    STEPS[f"plain_{_name}"] = _text


@query("link_arrivals", f"select {SCORES} from {{plain_member_scores}}")
def link_arrivals(t):
    """Three arrivals, each linked against the stored state; the result is that of one run over all records."""
    store = Store(t.spark, scratch(t.spark, "arrivals"))
    third = F.pmod(F.crc32(F.col("id").cast("binary")), F.lit(3))
    for number in range(3):
        run_arrivals(store, t("employers").where(third == number), rules=B.EMPLOYER_RULES)
    return stored_links(store)


# Records in groups that agree on name, city and state, some large, with outsiders near one member.
OF_GROUPS = [
    "rare_words", "blocks", "candidates", "vectors", "scored", "links", "ends", "clusters", "member_scores"
]


def of_groups(text: str) -> str:
    for name in ["employers", *OF_GROUPS]:
        text = text.replace(f"{{{name}}}", f"{{grouped_{name}}}")
    return text


for _name in OF_GROUPS:
    STEPS[f"grouped_{_name}"] = of_groups(STEPS[_name])


@query("link_records_groups", f"select {SCORES} from {{grouped_member_scores}}")
def link_records_groups(t):
    return link_records(t("grouped_employers"), RULES)


@query("link_records_groups_large_blocks", f"select {SCORES} from {{grouped_member_scores}}")
def link_records_groups_large_blocks(t):
    return link_records(t("grouped_employers"), RULES, max_block=2)


@query(
    "link_pipeline_groups",
    f"select {SCORES}, cast(null as boolean) as is_valid_cluster, cast(null as varchar) as review_date, "
    "false as processed from {grouped_member_scores}",
)
def link_pipeline_groups(t):
    return link_pipeline(t("grouped_employers"), entity_rows(t), refresh=True, rules=RULES)


# The same operators on other records.
@query(
    "collapse_copies_documents",
    "select text, lang, source, min(doc_id) as doc_id, count(*) as copies from {documents} group by text, lang, source",
)
def collapse_copies_documents(t):
    return P.collapse_copies(t("documents"), ["text", "lang", "source"], "doc_id")
