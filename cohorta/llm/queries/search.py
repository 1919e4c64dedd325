"""Queries that search for neighbours, links and repeated text."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from cohorta.llm import cross_polytope, jaccard_join, periodic_runs, ranked_search, suffix_levels
from cohorta.llm.common import table
from cohorta.llm.queries.registry import query


@query("op6_cross_polytope")
def neighbours(spark, folder):
    return cross_polytope.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op10_set_relations", sql="""
with recursive lists as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') as w from documents),
sets as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as g from lists),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
pairs as (
  select a.doc_id as x, b.doc_id as y, count(*) as o
  from sets a join sets b on a.g = b.g and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
links as (
  select x, y from pairs join sizes sx on sx.doc_id = x join sizes sy on sy.doc_id = y
  where 100 * o >= 80 * (sx.n + sy.n - o)),
reached as (select x, y from links union select r.x, l.y from reached r join links l on r.y = l.x),
least_reached as (select x, min(y) as y from reached group by x)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) as component_id
from documents d left join sizes s on s.doc_id = d.doc_id left join least_reached r on r.x = d.doc_id""")
def similar_documents(spark, folder):
    return jaccard_join.similar_classes(table(spark, folder, "documents"))


@query("op4_suffix_levels")
def repeats(spark, folder):
    cut = suffix_levels.remove_repeats(table(spark, folder, "documents"), with_bytes=False)
    removed = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda t, x: t + x)
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"),
                      F.lower(F.hex("kept")).alias("kept_sha256"))


# CRC-32 of the decimal id, bit by bit; then the contract's words and all runs: equal stretches of six
# words at two places, a period apart, are joined to islands.
@query("op12_periodic_runs", sql="""
with cut as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
         xor(4294967295::ubigint, list_reduce(
           flatten(list_transform(string_split(doc_id::varchar, ''), lambda ch: [ascii(ch)::ubigint, 0, 0, 0, 0, 0, 0, 0])),
           lambda c, v: xor(xor(c, v) >> 1, 3988292384::ubigint * (xor(c, v) & 1::ubigint)), 4294967295::ubigint))::bigint as h
  from documents),
placed as (
  select doc_id, w, len(w)::bigint as n, h % 10 = 0 and len(w) > 0 as planted, (h // 10) % greatest(len(w), 1) as a, h // 10 as g
  from cut),
texts as (
  select doc_id, n, case when planted then list_transform(range(0, n), lambda i:
           w[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + g % 8)) end]) else w end as w
  from placed),
flat as (select doc_id, n, unnest(w) as word, generate_subscripts(w, 1) - 1 as i from texts),
six as (
  select doc_id, n, i, word || ' ' || lead(word, 1) over o || ' ' || lead(word, 2) over o || ' ' || lead(word, 3) over o
         || ' ' || lead(word, 4) over o || ' ' || lead(word, 5) over o as g
  from flat window o as (partition by doc_id order by i)),
pairs as (
  select a.doc_id, a.i, b.i - a.i as p
  from six a join six b on a.doc_id = b.doc_id and a.g = b.g and b.i > a.i and 2 * (b.i - a.i) <= a.n),
islands as (select doc_id, p, i, i - row_number() over (partition by doc_id, p order by i) as island from pairs),
stretches as (
  select doc_id, p, min(i) as start, max(i) - min(i) + 6 + p as length from islands group by doc_id, p, island),
runs as (
  select doc_id, start, length, min(p) as period from stretches where length >= greatest(12, 2 * p)
  group by doc_id, start, length),
lists as (
  select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as rows,
         first(struct_pack(s := start, l := length, p := period) order by length desc, start, period) as best
  from runs group by doc_id),
repeated as (
  select distinct doc_id, unnest(range(start + period, start + length)) as i from runs),
kept as (
  select doc_id, string_agg(word, ' ' order by i) as collapsed
  from flat anti join repeated using (doc_id, i) group by doc_id)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, best.s::bigint as start, best.l::bigint as length,
       best.p::bigint as period, ((1000 * best.l) // best.p)::bigint as exponent_milli,
       sha256(coalesce(rows, '')) as runs_sha256, sha256(coalesce(collapsed, '')) as collapsed_sha256
from documents left join lists using (doc_id) left join kept using (doc_id)""")
def runs_of_words(spark, folder):
    def planted(doc_id, n):
        """The contract's words: in a tenth of the documents the tail repeats its first words."""
        h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
        if doc_id is None or h % 10:
            return None
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        i = np.arange(n)
        return np.where(i < a, i, a + (i - a) % p)

    found = periodic_runs.word_runs(table(spark, folder, "documents"), order=planted)
    rows = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(rows, lambda r: F.concat(r, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("op13_ranked_search", sql="""
with cut as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[0-9a-z\\x{80}-\\x{10FFFF}]+') as w from documents),
lengths as (select doc_id, len(w)::bigint as n from cut where len(w) > 0),
totals as (select count(*)::bigint as docs, sum(n)::bigint as words from lengths),
asked as (
  select item_id, term, count(*)::bigint as q
  from (select item_id, unnest(regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[0-9a-z\\x{80}-\\x{10FFFF}]+')) as term from benchmark)
  group by item_id, term),
held as (
  select doc_id, term, count(*)::bigint as tf from (select doc_id, unnest(w) as term from cut)
  where term in (select term from asked) group by doc_id, term),
weights as (
  select term, floor(1000 * ln((2.0::double * docs + 2) / (2 * df + 1)))::bigint as w
  from (select term, count(*) as df from held group by term), totals),
scores as (
  select item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words))))::bigint as score
  from asked join weights using (term) join held using (term) join lengths using (doc_id), totals
  group by item_id, doc_id),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
  from scores where score > 0)
select * from ranked where rank <= 10""")
def ranked_documents(spark, folder):
    return ranked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)
