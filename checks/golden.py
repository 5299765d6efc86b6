"""Review and canonical records."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import dialect as D
from checks.base import STEPS, query
from checks.gap import gap_distances
from reclink.functions.distance import affine_gap
from reclink.operators import canonical as K
from reclink.operators import review as R
from reclink.plans.resolution import canonicalize_all, canonicalize_clusters
from reclink.schemas import ENTITY_MAP, IDENTITY, REVIEW_THRESHOLD

NOW = "2024-03-01"
MAP = [f.name for f in ENTITY_MAP]


def entity_rows(t):
    return t("entity_map").select(*MAP)


def uniques(t):
    return t("uniques").withColumn("sources", F.array("sources"))


# ------------------------------------------------------------------------------------------------------------- review
STEPS["sizes"] = "select canon_id, count(*) as n_members from {entity_map} group by canon_id"
WAITING = f"cluster_score <= {REVIEW_THRESHOLD} and review_date is null"
STEPS["waiting"] = f"""
select employer_record_id, canon_id, cluster_score from {{entity_map}} where {WAITING}
order by canon_id, employer_record_id limit 100
"""
# The whole queue, in a map in which every tenth cluster is one cluster of thousands.
STEPS["every_waiting"] = f"select employer_record_id, canon_id, cluster_score from {{entity_map}} where {WAITING}"
STEPS["wide_map"] = """
select employer_record_id, case when hash_part = 0 then 'e000000000000' else canon_id end as canon_id, cluster_score
from (select *, cast(substr(canon_id, 8) as bigint) % 10 as hash_part from {entity_map}) x
"""


@query(
    "cluster_member_ids",
    "select m.canon_id, s.n_members, m.employer_record_id as member_id from {entity_map} m join {sizes} s on s.canon_id = m.canon_id",
)
def cluster_member_ids(t):
    return R.cluster_member_ids(entity_rows(t))


@query(
    "cluster_member_ids_wide",
    "select canon_id, count(*) over (partition by canon_id) as n_members, employer_record_id as member_id from {wide_map}",
)
def cluster_member_ids_wide(t):
    tenth = F.substring("canon_id", 8, 6).cast("bigint") % 10 == 0
    wide = entity_rows(t).withColumn("canon_id", F.when(tenth, F.lit("e000000000000")).otherwise(F.col("canon_id")))
    return R.cluster_member_ids(wide)


@query(
    "review_queue",
    "select w.employer_record_id, w.canon_id, round(w.cluster_score, 6) as cluster_score, m.n_members "
    "from {waiting} w join {sizes} m on m.canon_id = w.canon_id",
)
def review_queue(t):
    return R.review_queue(entity_rows(t), 100)


@query("review_count", f"select count(*) as to_review from {{entity_map}} where {WAITING}")
def review_count(t):
    return R.review_count(entity_rows(t))


STAR = "m.employer_record_id = w.employer_record_id"


@query(
    "review_rows",
    f"select w.employer_record_id as reviewed_id, case when {STAR} then '*' else '' end as star, e.id, e.name, "
    "e.trade_name_dba as trade_name, e.city, e.state, "
    "case when e.country = 'UNITED STATES OF AMERICA' then 'USA' else e.country end as country, "
    f"{D.print_phone('e.phone')} as phone, {D.day('e.first_seen')} as first_seen, {D.day('e.last_seen')} as last_seen, "
    f"e.source, case when {STAR} then printf('%.2f', w.cluster_score) else '' end as score "
    "from {every_waiting} w join {entity_map} m on m.canon_id = w.canon_id join {employers} e on e.id = m.employer_record_id",
)
def review_rows(t):
    return R.review_rows(R.review_queue(entity_rows(t), 1 << 30), entity_rows(t), t("employers"))


# Every waiting member gets an answer, some of them two, and a few answers are not valid.
STEPS["decisions"] = """
select employer_record_id, position, case (n + position) % 4 when 0 then 'y' when 1 then 'n' when 2 then 'u' else 'q' end
  as answer
from (select employer_record_id, cast(substr(employer_record_id, 2) as bigint) as n, 1 as position from {entity_map}
  where cluster_score <= 0.8
  union all select employer_record_id, cast(substr(employer_record_id, 2) as bigint), 2 from {entity_map}
  where cluster_score <= 0.7) x
"""


def decisions(t):
    n = F.substring("employer_record_id", 2, 12).cast("bigint")
    times = F.when(F.col("cluster_score") <= 0.7, F.array(F.lit(1), F.lit(2))).when(
        F.col("cluster_score") <= 0.8, F.array(F.lit(1))
    )
    asked = t("entity_map").select("employer_record_id", n.alias("n"), F.explode(times).alias("position"))
    answer = F.element_at(F.array(*[F.lit(a) for a in "ynuq"]), ((F.col("n") + F.col("position")) % 4 + 1).cast("int"))
    return asked.select("employer_record_id", "position", answer.alias("answer"))


STEPS["last_answers"] = """
select employer_record_id, answer from {decisions} where answer in ('y', 'n', 'u')
qualify row_number() over (partition by employer_record_id order by position desc) = 1
"""


@query(
    "apply_reviews",
    "select m.employer_record_id, m.canon_id, round(m.cluster_score, 6) as cluster_score, "
    "case when d.answer is null then m.is_valid_cluster when d.answer = 'y' then true when d.answer = 'n' then false end "
    f"as is_valid_cluster, case when d.answer is not null then '{NOW}' else {D.day('m.review_date')} end as review_date, "
    "m.processed from {entity_map} m left join {last_answers} d on d.employer_record_id = m.employer_record_id",
)
def apply_reviews(t):
    return R.apply_reviews(entity_rows(t), decisions(t), F.lit(NOW).cast("timestamp_ntz"))


@query("invalid_answers", "select employer_record_id, position, answer from {decisions} where answer = 'q'")
def invalid_answers(t):
    return R.invalid_answers(decisions(t))


# ---------------------------------------------------------------------------------------------------------- canonical
STEPS["eligible"] = f"""
select * from {{entity_map}} where cluster_score > {REVIEW_THRESHOLD} or is_valid_cluster
"""
STEPS["waiting_clusters"] = """
select canon_id, count(*) as n_members, max(processed::int) as processed_max, min(processed::int) as processed_min
from {eligible} group by canon_id having min(processed::int) = 0
"""


@query(
    "eligible_members",
    "select employer_record_id, canon_id, round(cluster_score, 6) as cluster_score, is_valid_cluster from {eligible}",
)
def eligible_members(t):
    return K.eligible_members(entity_rows(t)).select("employer_record_id", "canon_id", "cluster_score", "is_valid_cluster")


@query("clusters_to_process", "select canon_id, n_members, processed_max, processed_min from {waiting_clusters}")
def clusters_to_process(t):
    return K.clusters_to_process(entity_rows(t))


@query(
    "clusters_to_process_batch",
    "select canon_id, n_members, processed_max, processed_min from {waiting_clusters} order by canon_id limit 100",
)
def clusters_to_process_batch(t):
    return K.clusters_to_process(entity_rows(t), 100)


STEPS["fresh_members"] = """
select m.canon_id, e.* from {eligible} m
join {waiting_clusters} w on w.canon_id = m.canon_id and w.processed_max = 0
join {linked_employers} e on e.id = m.employer_record_id
"""
STEPS["cells"] = """
select canon_id, field, value, count(*) as copies, min(id) as first_id from (
""" + " union all ".join(f"select canon_id, id, '{f}' as field, {f} as value from {{fresh_members}}" for f in IDENTITY) + """
) x where value != '' group by canon_id, field, value
"""
STEPS["medoids"] = """
select canon_id, field, value from (
  select a.canon_id, a.field, a.value, a.first_id, sum(levenshtein(a.value, b.value) * b.copies) as total
  from {cells} a join {cells} b on a.canon_id = b.canon_id and a.field = b.field group by 1, 2, 3, 4) x
qualify row_number() over (partition by canon_id, field order by total, first_id) = 1
"""
STEPS["canon"] = (
    "select f.canon_id, "
    + ", ".join(f"max(case when m.field = '{f}' then m.value end) as {f}" for f in IDENTITY)
    + " from (select distinct canon_id from {fresh_members}) f left join {medoids} m on m.canon_id = f.canon_id group by 1"
)


def fresh_members(t):
    rows = entity_rows(t)
    waiting = K.clusters_to_process(rows).where("processed_max = 0")
    return K.cluster_members(rows, t("linked_employers"), waiting)


@query("canonical_values", f"select canon_id, {', '.join(IDENTITY)} from {{canon}}")
def canonical_values(t):
    return K.canonical_values(fresh_members(t))


STEPS["cell_pairs"] = """
select distinct a.value as a, b.value as b from {cells} a join {cells} b on a.canon_id = b.canon_id and a.field = b.field
"""
STEPS["cell_gaps"] = gap_distances("{cell_pairs}")
STEPS["gap_medoids"] = """
select canon_id, field, value from (
  select a.canon_id, a.field, a.value, a.first_id, round(sum(g.distance * b.copies), 9) as total
  from {cells} a join {cells} b on a.canon_id = b.canon_id and a.field = b.field
  join {cell_gaps} g on g.a = a.value and g.b = b.value group by 1, 2, 3, 4) x
qualify row_number() over (partition by canon_id, field order by total, first_id) = 1
"""
STEPS["gap_canon"] = STEPS["canon"].replace("{medoids}", "{gap_medoids}")


@query("canonical_values_gap", f"select canon_id, {', '.join(IDENTITY)} from {{gap_canon}}")
def canonical_values_gap(t):
    return K.canonical_values(fresh_members(t), distance=affine_gap)


STEPS["spans"] = """
select canon_id, min(first_seen) as first_seen, max(last_seen) as last_seen,
  array_to_string(list_sort(list(distinct source)), ',') as sources from {fresh_members} group by canon_id
"""


@query("cluster_span", f"select canon_id, {D.day('first_seen')} as first_seen, {D.day('last_seen')} as last_seen, sources from {{spans}}")
def cluster_span(t):
    return K.cluster_span(fresh_members(t))


IDENTITY_KEY = D.text_key(*IDENTITY)
STEPS["held"] = f"select {IDENTITY_KEY} as own, count(*) as n, min(id) as id from {{uniques}} group by 1"
STEPS["matched"] = f"""
select c.*, case when h.n = 1 then h.id when h.n is null then c.own end as unique_employer_id,
  case when h.n = 1 then 'matched' when h.n > 1 then 'ambiguous' else 'created' end as outcome
from (select *, {IDENTITY_KEY} as own from {{canon}}) c left join {{held}} h on h.own = c.own
"""


@query("match_or_create", f"select canon_id, {', '.join(IDENTITY)}, unique_employer_id, outcome from {{matched}}")
def match_or_create(t):
    return K.match_or_create(K.canonical_values(fresh_members(t)), uniques(t))


STEPS["assigned"] = """
select canon_id, unique_employer_id from {matched} where unique_employer_id is not null
"""
STEPS["hits"] = """
select m.employer_record_id, a.unique_employer_id from {eligible} m join {assigned} a on a.canon_id = m.canon_id
"""


def assigned(t):
    found = K.match_or_create(K.canonical_values(fresh_members(t)), uniques(t))
    return K.assign_unique(t("linked_employers"), entity_rows(t), found.select("canon_id", "unique_employer_id"))


@query(
    "assign_unique",
    "select e.id, coalesce(h.unique_employer_id, e.unique_employer_id) as unique_employer_id "
    "from {linked_employers} e left join {hits} h on h.employer_record_id = e.id",
)
def assign_unique(t):
    return assigned(t)[0].select("id", "unique_employer_id")


@query(
    "assign_unique_map",
    "select m.employer_record_id, m.canon_id, m.processed or h.employer_record_id is not null as processed "
    "from {entity_map} m left join {hits} h on h.employer_record_id = m.employer_record_id",
)
def assign_unique_map(t):
    return assigned(t)[1].select("employer_record_id", "canon_id", "processed")


STEPS["partly"] = """
select m.canon_id, max(e.unique_employer_id) as unique_employer_id from {eligible} m
join {waiting_clusters} w on w.canon_id = m.canon_id and w.processed_max = 1
join {linked_employers} e on e.id = m.employer_record_id group by m.canon_id
"""
STEPS["partly_hits"] = """
select m.employer_record_id, p.unique_employer_id from {eligible} m join {partly} p on p.canon_id = m.canon_id
where p.unique_employer_id is not null
"""


@query(
    "extend_processed",
    "select e.id, coalesce(h.unique_employer_id, e.unique_employer_id) as unique_employer_id "
    "from {linked_employers} e left join {partly_hits} h on h.employer_record_id = e.id",
)
def extend_processed(t):
    return K.extend_processed(t("linked_employers"), entity_rows(t))[0].select("id", "unique_employer_id")


@query(
    "extend_processed_map",
    "select m.employer_record_id, m.processed or h.employer_record_id is not null as processed "
    "from {entity_map} m left join {partly_hits} h on h.employer_record_id = m.employer_record_id",
)
def extend_processed_map(t):
    return K.extend_processed(t("linked_employers"), entity_rows(t))[1].select("employer_record_id", "processed")


# The map of strong members only, so that the others stand alone.
STEPS["strong_map"] = "select * from {entity_map} where cluster_score > 0.75"
UNIQUE = ["id", *IDENTITY, "sources", "first_seen", "last_seen"]
STEPS["singles"] = """
select md5(concat('employer:', e.id)) as id, e.name, e.trade_name_dba, e.city, e.state, e.country, e.phone,
  e.source as sources, e.first_seen, e.last_seen, e.id as employer_id
from {linked_employers} e where e.unique_employer_id is null
  and e.id not in (select employer_record_id from {strong_map})
"""


def unique_sql(step: str) -> str:
    cells = ", ".join(f"{D.day(c)} as {c}" if c.endswith("_seen") else c for c in UNIQUE)
    return f"select {cells} from {{{step}}}"


def strong_map(t):
    return entity_rows(t).where("cluster_score > 0.75")


@query("singleton_uniques", unique_sql("singles"))
def singleton_uniques(t):
    return K.singleton_uniques(t("linked_employers"), strong_map(t))[0]


@query(
    "singleton_uniques_links",
    "select e.id, coalesce(e.unique_employer_id, s.id) as unique_employer_id "
    "from {linked_employers} e left join {singles} s on s.employer_id = e.id",
)
def singleton_uniques_links(t):
    return K.singleton_uniques(t("linked_employers"), strong_map(t))[1].select("id", "unique_employer_id")


STEPS["created"] = """
select m.unique_employer_id as id, any_value(m.name) as name, any_value(m.trade_name_dba) as trade_name_dba,
  any_value(m.city) as city, any_value(m.state) as state, any_value(m.country) as country, any_value(m.phone) as phone,
  array_to_string(list_sort(list_distinct(flatten(list(string_split(s.sources, ','))))), ',') as sources,
  min(s.first_seen) as first_seen, max(s.last_seen) as last_seen
from {matched} m join {spans} s on s.canon_id = m.canon_id where m.outcome = 'created' group by m.unique_employer_id
"""
COLUMNS = ", ".join(UNIQUE)
STEPS["final_uniques"] = f"select {COLUMNS} from {{uniques}} union all select {COLUMNS} from {{created}}"


def clustered(t):
    return canonicalize_clusters(t("linked_employers"), entity_rows(t), uniques(t))


@query("canonicalize_clusters", unique_sql("final_uniques"))
def canonicalize_clusters_query(t):
    return clustered(t).uniques


@query(
    "canonicalize_clusters_links",
    "select e.id, coalesce(h.unique_employer_id, p.unique_employer_id, e.unique_employer_id) as unique_employer_id "
    "from {linked_employers} e left join {hits} h on h.employer_record_id = e.id "
    "left join {partly_hits} p on p.employer_record_id = e.id",
)
def canonicalize_clusters_links(t):
    return clustered(t).employers.select("id", "unique_employer_id")


@query("canonicalize_clusters_errors", f"select canon_id, {', '.join(IDENTITY)} from {{matched}} where outcome = 'ambiguous'")
def canonicalize_clusters_errors(t):
    return clustered(t).errors.select("canon_id", *IDENTITY)


# The whole map, and beside it employers that no row of it names: copies of every fourth employer under other ids.
STEPS["more_employers"] = """
select * from {linked_employers} union all
select * replace (concat('S', substr(id, 2)) as id, cast(null as varchar) as unique_employer_id) from {linked_employers}
where cast(substr(id, 2) as bigint) % 8 in (4, 5)
"""
STEPS["whole_singles"] = """
select e.id as employer_id, md5(concat('employer:', e.id)) as id, e.name, e.trade_name_dba, e.city, e.state, e.country,
  e.phone, e.source as sources, e.first_seen, e.last_seen
from {more_employers} e where e.unique_employer_id is null and e.id not in (select employer_record_id from {entity_map})
"""
STEPS["every_unique_whole"] = (
    f"select {COLUMNS} from {{uniques}} union all select {COLUMNS} from {{created}} "
    f"union all select {COLUMNS} from {{whole_singles}}"
)


def canonical_whole(t):
    linked = t("linked_employers")
    copies = linked.where((F.substring("id", 2, 12).cast("bigint") % 8).isin(4, 5)).withColumns(
        {"id": F.concat(F.lit("S"), F.substring("id", 2, 12)), "unique_employer_id": F.lit(None).cast("string")}
    )
    return canonicalize_all(linked.unionByName(copies), entity_rows(t), uniques(t))


@query("canonicalize_all", unique_sql("every_unique_whole"))
def canonicalize_all_query(t):
    return canonical_whole(t).uniques


@query(
    "canonicalize_all_links",
    "select e.id, coalesce(h.unique_employer_id, p.unique_employer_id, e.unique_employer_id, s.id) as unique_employer_id "
    "from {more_employers} e left join {hits} h on h.employer_record_id = e.id "
    "left join {partly_hits} p on p.employer_record_id = e.id left join {whole_singles} s on s.employer_id = e.id",
)
def canonicalize_all_links(t):
    return canonical_whole(t).employers.select("id", "unique_employer_id")


@query(
    "canonicalize_all_map",
    "select m.employer_record_id, m.canon_id, m.processed or h.employer_record_id is not null "
    "or p.employer_record_id is not null as processed from {entity_map} m "
    "left join {hits} h on h.employer_record_id = m.employer_record_id "
    "left join {partly_hits} p on p.employer_record_id = m.employer_record_id",
)
def canonicalize_all_map(t):
    return canonical_whole(t).entity_map.select("employer_record_id", "canon_id", "processed")
