"""The queries of the numbered operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, crosspolytope, lines, mixing, packing, quality, runindex, sigtree, superkmers, warc
from .common import load


def op4_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmers.remove_repeated_windows(load(spark, sf_dir, "documents"), keep_text=False).drop("kept")


def op5_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op6_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.training_order(load(spark, sf_dir, "documents")).drop("source")


def op7_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(load(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")


def op1_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runindex.remove_repeated_bytes(load(spark, sf_dir, "documents"), keep_text=False).drop("kept")


def op2_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse_and_render(load(spark, sf_dir, "conversations"))


def op3_segment_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(load(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to")


def op8_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(load(spark, sf_dir, "documents"))
    return kept.select("doc_id", "lines_removed", "runs_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"), F.octet_length("text").cast("long").alias("kept_bytes"))


def op9_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sigtree.jaccard_groups(load(spark, sf_dir, "documents"))


def op10_ordered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_run_length_index, op2_snapshot_collapse, op3_segment_reassembly, op4_super_kmers, op5_cross_polytope, op6_curriculum_mix, op7_robust_outliers, op8_line_runs, op9_signature_trees, op10_ordered_packing)}
ORACLES: dict[str, str] = {
    "op2_snapshot_collapse": """
        with t as (select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations),
        n as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as ordinal from t),
        p as (select conv_id, ordinal, md5(string_agg(strlen(role) || ':' || strlen(text) || ':' || role || text, '' order by ordinal) over (partition by conv_id order by ordinal rows unbounded preceding)) as h,
                     count(*) over (partition by conv_id) as turns from n),
        m as (select ordinal, h, min(conv_id) as conv_id, any_value(turns) as turns from p where ordinal = turns and not exists (select 1 from p q where q.ordinal = p.ordinal and q.h = p.h and q.turns > q.ordinal) group by ordinal, h)
        select n.conv_id, ((n.ordinal - 1) // 64)::bigint as part, m.turns::bigint as turns,
               string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' order by n.ordinal) as text
        from n join m using (conv_id) group by n.conv_id, (n.ordinal - 1) // 64, m.turns
    """,
    "op3_segment_reassembly": """
        with p as (select page_id, coalesce(html, '') as html from pages),
        d as (select page_id, strlen(html)::bigint as payload_bytes, sha1(html) as payload_digest,
                     max(page_id) over (partition by html) as response from p)
        select page_id, payload_bytes, payload_digest,
               case when payload_bytes >= 1000 and response <> page_id then 'revisit' else 'response' end as record_type,
               case when payload_bytes >= 1000 and response <> page_id then response end as refers_to
        from d
    """,
    "op8_line_runs": """
        with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as nr from documents where text is not null),
        w as (select doc_id, nr, line, row_number() over (partition by doc_id order by nr) - 1 as pos from l where regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
        a as (select doc_id, list(line order by pos) as ls from w group by doc_id),
        v as (select doc_id, ls, depth, unnest(range(0, len(ls) - depth + 1)) as pos from a join (select (1 << unnest(range(1, 21)))::bigint as depth) on len(ls) >= depth),
        h as (select doc_id, pos, depth::bigint as depth, md5(array_to_string(list_slice(ls, pos + 1, pos + depth::bigint), chr(10))) as lines from v),
        f as (select doc_id, pos, depth, min((doc_id, pos)) over (partition by depth, lines) as first from h),
        c as (select doc_id, pos, max(depth) as depth, arg_max(first, depth) as first from f where first <> (doc_id, pos) group by doc_id, pos),
        o as (select doc_id, pos, pos + depth as stop, first[1] as source, first[2] - pos as shift from c),
        b as (select *, coalesce(max(stop) over (partition by doc_id, source, shift order by pos rows between unbounded preceding and 1 preceding), -1) < pos as opens from o),
        n as (select *, sum(opens::int) over (partition by doc_id, source, shift order by pos) as nr from b),
        u as (select distinct doc_id, min(pos) as start, max(stop) as stop from n group by doc_id, source, shift, nr),
        m as (select * from u where not exists (select 1 from u z where z.doc_id = u.doc_id and z.start <= u.start and z.stop >= u.stop and (z.start < u.start or z.stop > u.stop))),
        g as (select distinct doc_id, unnest(range(start, stop)) as pos from m),
        r as (select doc_id, count(*) as lines_removed, (select count(*) from m where m.doc_id = g.doc_id) as runs_removed from g group by doc_id),
        k as (select l.doc_id, string_agg(l.line, chr(10) order by l.nr) as kept from l left join w using (doc_id, nr) left join g on g.doc_id = l.doc_id and g.pos = w.pos where g.pos is null group by l.doc_id)
        select d.doc_id, coalesce(lines_removed, 0)::bigint as lines_removed, coalesce(runs_removed, 0)::bigint as runs_removed,
               case when d.text is not null then sha256(coalesce(kept, '')) end as kept_sha256,
               case when d.text is not null then strlen(coalesce(kept, ''))::bigint end as kept_bytes
        from documents d left join r using (doc_id) left join k using (doc_id)
    """,
    "op4_super_kmers": """
        with d as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
        v as (select doc_id, pos, array_to_string(list_slice(w, pos, pos + 12), ' ') as win from (select doc_id, w, unnest(range(1, len(w) - 11)) as pos from d)),
        f as (select doc_id, pos, min(doc_id) over (partition by win) as first from v),
        g as (select distinct doc_id, pos + k as pos from f, range(13) r(k) where first < doc_id),
        w as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as pos from d),
        k as (select w.doc_id, count(g.pos)::bigint as n_removed, string_agg(word, ' ' order by w.pos) filter (g.pos is null) as kept from w left join g using (doc_id, pos) group by w.doc_id)
        select d.doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join k using (doc_id)
    """,
    "op9_signature_trees": """
        with recursive d as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
        s as (select distinct doc_id, unnest(case when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: array_to_string(list_slice(w, i, i + 2), ' ')) else [array_to_string(w, ' ')] end) as g from d where len(w) > 0),
        n as (select doc_id, count(*) as n from s group by 1),
        p as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
        l as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 90 * (nx.n + ny.n - c)),
        e as (select x, y from l union all select y, x from l),
        r as (select doc_id as id, doc_id as root from d union select e.y, r.root from r join e on r.id = e.x)
        select d.doc_id, coalesce(n, 0)::bigint as n_shingles, min(root) as component_id from d left join n using (doc_id) join r on r.id = d.doc_id group by all
    """,
}
