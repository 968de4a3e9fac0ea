"""The queries in SQL, written for DuckDB on the same tables."""

from __future__ import annotations

# Common table expressions ----------------------------------------------------

REV = """
rev as (
  select user_id,
         case when user_id % 3 = 0 then 'f' || user_id || '.txt'
              when user_id % 3 = 1 then 'd' || (user_id % 7) || '/f' || user_id || '.txt'
              else 'd' || (user_id % 7) || '/s' || (user_id % 5) || '/f' || user_id || '.txt' end as path,
         user_id % 3 as path_depth,
         cast(row_number() over (partition by user_id order by ts, event_id) as int) as rn,
         event_type = 'error' as is_dead,
         date_trunc('second', ts) as date,
         'user' || (user_id % 20) as author, props as comment, cast(event_id as varchar) as commit_id
  from events),
live as (select * from rev where not (rn = 1 and is_dead)),
noise as (select path, rn from rev where rn = 1 and is_dead),
pos as (select *, row_number() over (order by date, path_depth, path, rn) as p from live)"""

TAGS = REV + """,
bound as (select k, timestamp '2024-01-01 00:00:00' + to_days(cast(3 * k as int)) as hi
          from (select unnest(range(1, (
            select max(date_diff('day', timestamp '2024-01-01', ts)) // 3 + 2 from events))) as k) z),
state as (select k, path, max(rn) as rn from rev join bound on date < hi group by k, path),
tags as (
  select 'T' || k as tag, path, rn from state
  union all
  select 'X' || k, path, max(rn) from rev join bound
    on date < case when user_id % 2 = 0 then hi else hi - interval '3' day end group by k, path
  union all select 'P' || k, path, rn from state
  union all select 'P' || k, 'ghost.txt', 1 from bound
  union all select 'N' || k, 'ghost.txt', 1 from bound),
clean as (select t.* from tags t where not exists (select 1 from noise n where n.path = t.path and n.rn = t.rn))"""

OWN = """
own as (
  select cast(o_custkey % 8 + 1 as int) as k, 'B' || (o_custkey % 8 + 1) as branch, 'o' || o_custkey || '.txt' as path,
         cast(row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as int) as rn,
         o_orderstatus = 'P' as is_dead, o_orderdate as date, cast(o_orderkey as varchar) as commit_id
  from orders),
own_rev as (select *, '1.1.' || (2 * k) || '.' || rn as version from own),
own_head as (select k, path, max(rn) as rn from own group by k, path)"""

# entries: magic numbers of the branches; parent: the versions they start from.
ENTRIES = TAGS + "," + OWN + """,
parents as (
  select cast(k as int) as k, path, '1.' || rn as version from state where k % 2 = 1 and k <= 8
  union all
  select cast(k + 1 as int), path, '1.' || rn from state where k % 2 = 1 and k < 8
  union all
  select k + 1, path, '1.1.' || (2 * k) || '.' || rn from own_head where k % 2 = 1
  union all
  select k, path, '1.1' from own_head),
entries as (select 'B' || k as tag, path, version || '.0.' || (2 * k) as version from parents),
named as (select tag, path, '1.' || rn as version from tags union all select tag, path, version from entries),
anchors as (
  select cast(substr(tag, 2) as int) as k, arg_max(p.path, p.p) as path, '1.' || arg_max(p.rn, p.p) as version,
         arg_max(p.date, p.p) as date, max(p.p) as p, count(*) as n_hits
  from clean c join pos p on p.path = c.path and p.rn = c.rn where tag like 'T%' group by tag),
own_pos as (select *, row_number() over (partition by k order by date, path, rn) as p from own_rev),
heads as (select k, arg_max(path, p) as path, arg_max(version, p) as version, arg_max(date, p) as date, max(p) as p
          from own_pos group by k),
placed as (
  select 'master' as branch, null as parent, 'NONE' as method, null as path, null as version, null as date
  union all
  select 'B' || k, 'master', 'GRAFTED', path, version, date from anchors where k % 2 = 1 and k <= 8
  union all
  select 'B' || (k + 1), 'B' || k, 'GRAFTED', path, version, date from heads where k % 2 = 1)"""

LOCATED = TAGS + """,
anchor as (select c.tag, max(o.p) as p from clean c join pos o on o.path = c.path and o.rn = c.rn group by c.tag),
seen as (select a.tag, o.path, max(o.rn) as rn from anchor a join pos o on o.p <= a.p group by a.tag, o.path),
counted as (
  select c.tag, count(*) as n_files,
         cast(sum(case when f.rn is null then 1 else 0 end) as bigint) as n_missing,
         cast(sum(case when f.rn <> c.rn then 1 else 0 end) as bigint) as n_wrong
  from clean c left join seen f on f.tag = c.tag and f.path = c.path group by c.tag),
located as (
  select c.tag, n_files, n_missing, n_wrong,
         case when a.p is null then 'NOT_FOUND' when n_wrong > 0 then 'OUT_OF_SYNC'
              when n_missing > 0 then 'PARTIAL' else 'FOUND' end as status,
         o.path as anchor_path, '1.' || o.rn as anchor_version, cast(o.date as varchar) as anchor_date
  from counted c left join anchor a on a.tag = c.tag left join pos o on o.p = a.p)"""

FILES = """
version as (select unnest([1, 2]) as rn),
contents as (
  select *, sha1(encode('blob ' || octet_length(encode(text))) || '\\x00'::blob || encode(text)) as blob_id
  from (select 'p' || (doc_id % 7) || '/' || doc_id || '.txt' as path, rn, doc_id,
               case when rn = 2 and doc_id % 5 < 2 then replace(text, ' a ', ' some ') else text end as text
        from documents, version where (doc_id % 5 <> 3 or rn = 1) and (doc_id % 5 <> 4 or rn = 2)) z)"""

BLOCK = """
block as (
  select *, 'revision 1.' || rn || chr(10) || 'date: ' || cast(date as varchar) || ' +0000;  author: ' || author
            || ';  state: ' || case when is_dead then 'dead' else 'Exp' end || ';  commitid: ' || commit_id
            || ';' || chr(10) || comment as block,
         'revision 1.' || rn || chr(10) || 'author: ' || author
            || ';  state: ' || case when is_dead then 'dead' else 'Exp' end || ';  commitid: ' || commit_id
            || ';' || chr(10) || comment as broken
  from rev)"""

HEAD_FILES = """
head_files as (
  select path, arg_max(rn, rn) as rn, arg_max(is_dead, rn) as is_dead, arg_max(commit_id, rn) as commit_id
  from live group by path),
head_live as (select path, '1.' || rn as version, commit_id from head_files where not is_dead)"""

PARTS = REV + """,
old as (select * from live where date < timestamp '2024-01-15' and cast(commit_id as bigint) % 101 <> 0),
head as (select date, path_depth, path, rn from old order by date desc, path_depth desc, path desc, rn desc limit 1),
fresh as (
  select l.* from live l, head h
  where (l.date, l.path_depth, l.path, l.rn) > (h.date, h.path_depth, h.path, h.rn))"""

VERSION = "path, '1.' || rn as version, cast(date as varchar) as date"
PARSED = VERSION + ", is_dead, author, comment, commit_id"
LINES = """
lines as (
  select path, line, case when rn = 1 then -1 else 1 end as n
  from (select path, rn, unnest(string_split(text, chr(10))) as line from contents) z),
delta as (select path, line, cast(sum(n) as bigint) as delta from lines group by path, line having sum(n) <> 0)"""


def digest_sql(entry: str) -> str:
    hashed = f"sha1({entry})"
    parts = [
        f"cast(sum(('0x' || substr({hashed}, {start}, 15))::ubigint::hugeint) as varchar)" for start in (1, 16)
    ]
    return f"sha1(cast(count(*) as varchar) || ':' || {parts[0]} || ':' || {parts[1]})"


LINEAGE = """
chain as (
  select 'B' || k as branch, 'master' as ancestor, 0 as level, p, path, version, date from anchors where k % 2 = 1 and k <= 8
  union all
  select 'B' || (k + 1), 'master', 0, p, path, version, date from anchors where k % 2 = 1 and k < 8
  union all
  select 'B' || (k + 1), 'B' || k, 1, p, path, version, date from heads where k % 2 = 1
  union all
  select 'B' || k, 'B' || k, case when k % 2 = 1 then 1 else 2 end, null, null, null, null from heads)"""

# Commits of all branches, those on inherited files too, and the full history of every branch.
HISTORY = """
edits as (
  select 'B' || (user_id % 8 + 1) as branch, path, path_depth, rn, '1.' || rn || '.' || (2 * (user_id % 8 + 1)) || '.1' as version,
         cast(commit_id as bigint) % 10 = 0 as is_dead, commit_id,
         case when cast(commit_id as bigint) % 3 = 0 then date - to_days(10957) else date end as date
  from live where cast(commit_id as bigint) % 5 = 0),
everything as (
  select 'master' as branch, path, path_depth, rn, '1.' || rn as version, is_dead, commit_id, date from live
  union all select branch, path, 0, rn, version, is_dead, commit_id, date from own_rev
  union all select branch, path, path_depth, rn, version, is_dead, commit_id, date from edits),
cap as (
  select c.*, coalesce(o.path_depth, 0) as cap_depth, coalesce(o.rn, w.rn) as cap_rn
  from chain c left join pos o on c.ancestor = 'master' and o.p = c.p
  left join own_rev w on c.level = 1 and c.path = w.path and c.version = w.version
  union all select 'master', 'master', 0, null, null, null, null, null, null),
full_history as (
  select c.branch, c.ancestor, c.level, e.path, e.path_depth, e.rn, e.version, e.is_dead, e.commit_id, e.date
  from everything e join cap c on c.ancestor = e.branch
  where c.path is null or (e.date, e.path_depth, e.path, e.rn) <= (c.date, c.cap_depth, c.path, c.cap_rn)),
spans as (
  select *, lead(level) over w as next_level, lead(path) over w as next_path, lead(version) over w as next_version,
         lead(date) over w as next_date, lead(rn) over w as next_rn, lag(is_dead, 1, true) over w as was_dead
  from full_history window w as (partition by branch, path order by level, date, path_depth, rn))"""

NOTE = """'CVS_PATH: ' || path || chr(10) || 'CVS_REV: 1.' || rn || chr(10)
  || case when is_dead then 'dead' else 'alive' end || chr(10)"""

ORACLES: dict[str, str] = {
    "commit_order": f"with {REV} select p as position, {VERSION} from pos",
    "pointless_split": f"""with {REV}
        select case when rn = 1 and is_dead then 'noise' else 'useful' end as kind, {VERSION} from rev""",
    "version_fns": f"""with {ENTRIES},
        v as (select '1.' || rn as v from rev union select version from own_rev
              union select version from entries union select '1.1.' || rn from rev),
        s as (select v, string_split(v, '.') as a from v)
        select v, v as rendered, a[-2] = '0' as is_branch,
               case when len(a) >= 4 then array_to_string(a[1:len(a) - 2], '.') end as branch_parent,
               cast(len(a) // 2 as int) as depth, len(a) % 2 = 1 as is_vendor from s""",
    "path_clean": f"""with {REV}, p as (select distinct path from rev)
        select '/srv/root/mod/' || regexp_replace(path, '([^/]*)$', 'Attic/\\1') || ',v' as raw, path as cleaned,
               case when path like '%/%' then regexp_replace(path, '/[^/]*$', '') else '' end as dir,
               string_split(path, '/')[-1] as leaf from p""",
    "date_parse": f"""with {REV},
        k as (select commit_id, date, cast(commit_id as bigint) % 3 as kind from rev),
        r as (select commit_id,
                case kind when 0 then cast(date as varchar) || ' +0200'
                          when 1 then strftime(date, '%Y/%m/%d %H:%M:%S') else 'on ' || cast(date as varchar) end as raw,
                case kind when 0 then date - interval '2' hour when 1 then date end as parsed from k)
        select commit_id, raw, cast(parsed as varchar) as parsed, strftime(parsed, '%Y/%m/%d') as day from r""",
    "date_bounds": f"""with {REV} select {VERSION} from rev
        where date > timestamp '2024-01-05' and date < timestamp '2024-01-15'""",
    "file_list": f"with {REV} select distinct path from rev",
    "commit_lookup": f"""with {REV} select {VERSION}, author, is_dead, comment, commit_id
        from rev where path = 'f3.txt' and rn = 2""",
    "ref_list": f"""with {TAGS}, {OWN},
        names as (select 'master' as name union select branch from own)
        select 'branch' as kind, name, 'refs/remotes/cvs/' || name as ref from names
        union all select distinct 'tag', tag, 'refs/tags/' || tag from tags""",
    "content_lookup": f"""with {FILES}
        select path, '1.' || rn as version, cast(octet_length(encode(text)) as bigint) as n_bytes, md5(text) as md5
        from contents where not (rn = 2 and doc_id % 11 = 0)""",
    "content_digest": f"with {FILES} select path, '1.' || rn as version, blob_id from contents",
    "note_roundtrip": f"""with {REV}, n as (
          select *, case when cast(commit_id as bigint) % 4 > 0 then commit_id end as id from rev)
        select {NOTE} || coalesce('CVS_COMMIT_ID: ' || id, '') || chr(10) as note,
               path, '1.' || rn as version, is_dead, id as commit_id from n""",
    "rlog_scan": f"with {REV} select {PARSED} from rev",
    "rlog_blocks": f"with {REV}, {BLOCK} select path, cast(-rn as bigint) as step, md5(block) as md5 from block",
    "rlog_parse": f"with {REV} select {PARSED} from rev",
    "rlog_corrupt": f"""with {REV}, {BLOCK} select path, cast(-rn as bigint) as step, md5(broken) as md5
        from block where cast(commit_id as bigint) % 50 = 7""",
    "tag_table": f"with {TAGS} select tag, path, '1.' || rn as version from tags",
    "tag_names": f"""with {ENTRIES}
        select distinct 'branch' as kind, tag from entries union all select distinct 'tag', tag from tags
        union all select distinct 'ghost', tag from tags where path = 'ghost.txt'""",
    "resolve_tags": f"""with {TAGS}
        select tag, path, '1.' || rn as version from tags where tag like 'T%'
        union all select 'unknown' || k, null, null from bound""",
    "tag_maps": f"""with {TAGS}
        select tag, cast(('0x' || substr(md5(path), 1, 8))::ubigint % 64 as int) as bucket, count(*) as n_files,
               string_agg(path || '=1.' || rn, ',' order by path || '=1.' || rn) as files
        from tags group by 1, 2""",
    "tag_map_fns": f"""with {ENTRIES},
        e as (select tag, path, version, len(string_split(version, '.')) as n,
                     string_split(version, '.')[-2] = '0' as magic from named)
        select tag, cast(count(*) filter (path <> 'ghost.txt') + 1 as bigint) as n_with, '1.9' as ghost_version,
               bool_or(path = 'ghost.txt') as has_ghost, bool_or(path = 'ghost.txt' and version = '1.1') as has_ghost_commit,
               cast(count(*) filter (path not in ('ghost.txt', 'f3.txt')) as bigint) as n_without,
               cast(max(n // 2) as int) as depth, bool_or(magic) as is_branch,
               cast(count(*) filter (n >= 4) as bigint) as n_parent
        from e group by tag""",
    "tag_summary": f"""with {ENTRIES},
        e as (select tag, len(string_split(version, '.')) as n, string_split(version, '.')[-2] = '0' as magic from named)
        select tag, count(*) as n_files, cast(max(n // 2) as int) as depth, bool_or(magic) as is_branch,
               bool_or(magic) and not bool_and(magic) as mixed from e group by tag""",
    "tag_classes": f"""with {TAGS},
        g as (select tag, count(*) as n_files, string_agg(path || ':' || rn, ',' order by path) as files from tags group by tag)
        select tag, min(tag) over (partition by files) as class, count(*) over (partition by files) as n_tags, n_files from g""",
    "tag_message": f"""with {TAGS}
        select distinct tag, null as path, tag as line from tags
        union all select tag, path, path || ' : 1.' || rn from tags""",
    "branch_parent": f"with {ENTRIES} select 'B' || k as tag, path, version from parents",
    "branch_depths": f"""with {ENTRIES}
        select tag, cast(max(len(string_split(version, '.')) // 2) as int) as depth from entries group by tag""",
    "branch_select": f"""with {REV}, {OWN}
        select 'master' as branch, {VERSION} from rev
        union all select branch, path, version, cast(date as varchar) from own_rev
        union all select 'master', path, '1.1', cast(min(date) as varchar) from own group by path""",
    "commits_for_tag": f"""with {TAGS} select r.path, '1.' || r.rn as version, cast(r.date as varchar) as date, r.author
        from rev r join tags t on t.path = r.path and t.rn = r.rn and t.tag = 'T5'""",
    "tag_hits": f"""with {TAGS} select t.tag, r.path, '1.' || r.rn as version, cast(r.date as varchar) as date, r.is_dead
        from tags t join rev r on r.path = t.path and r.rn = t.rn""",
    "clean_tags": f"with {TAGS} select tag, path, '1.' || rn as version from clean",
    "tag_locate": f"""with {LOCATED} select tag, n_files, n_missing, n_wrong, status,
        anchor_path, anchor_version, anchor_date from located""",
    "tag_locate_all": f"""with {ENTRIES}, {LOCATED.removeprefix(TAGS + ",")},
        all_noise as (select path, '1.' || rn as version from noise union all select path, '1.1' from own_head),
        start as (select 'SB' || k as tag, k, count(*) as n_files from parents q
                  where not exists (select 1 from all_noise n where n.path = q.path and n.version = q.version) group by k)
        select tag, case when status <> 'NOT_FOUND' then 'master' end as branch,
               case when status <> 'NOT_FOUND' then 'master' end as owner, status, n_files, n_missing, n_wrong,
               anchor_path, anchor_version, anchor_date from located
        union all
        select s.tag, p.parent, p.parent, 'FOUND', s.n_files, 0, 0, p.path, p.version, cast(p.date as varchar)
        from start s join placed p on p.branch = 'B' || s.k""",
    "tag_upsert": f"""with {TAGS},
        hit as (select c.tag, p.path || ' 1.' || p.rn as place, p.p, p.date from clean c join pos p on p.path = c.path and p.rn = c.rn),
        early as (select tag, arg_max(place, p) as place from hit
                  where date < timestamp '2024-01-15' and tag not in ('T3', 'X3') group by tag),
        late as (select tag, arg_max(place, p) as place from hit where tag not in ('T1', 'X1') group by tag)
        select coalesce(e.tag, l.tag) as tag,
               case when e.tag is null then 'INSERT' when l.tag is null then 'KEEP'
                    when e.place = l.place then 'NOOP' else 'UPDATE' end as action,
               coalesce(l.place, e.place) as place
        from early e full outer join late l on l.tag = e.tag""",
    "file_intervals": f"""with {REV},
        n as (select path, rn, date, lead(rn) over w as next_rn, lead(date) over w as next_date from live
              window w as (partition by path order by date, rn))
        select {VERSION}, case when next_rn is not null then path end as next_path,
               '1.' || next_rn as next_version, cast(next_date as varchar) as next_date from n""",
    "snapshot_asof": f"""with {REV},
        s as (select path, max(rn) as rn, arg_max(is_dead, rn) as is_dead, arg_max(author, rn) as author
              from live where date <= timestamp '2024-01-15 12:00:00' group by path)
        select 'master' as branch, path, '1.' || rn as version, author from s where not is_dead""",
    "live_file_counts": f"""with {REV},
        d as (select *, cast(not is_dead as int)
                - cast(not coalesce(lag(is_dead) over (partition by path order by date, rn), true) as int) as change from live)
        select {VERSION}, cast(sum(change) over (order by date, path_depth, path, rn rows unbounded preceding) as bigint) as live_files
        from d""",
    "parent_links": f"""with {REV},
        n as (select path, rn, date, lag(path) over w as pp, lag(rn) over w as pr, lag(date) over w as pd from live
              window w as (order by date, path_depth, path, rn))
        select {VERSION}, pp as parent_path, '1.' || pr as parent_version, cast(pd as varchar) as parent_date from n""",
    "branch_heads": f"""with {ENTRIES}
        select 'B' || k as branch, path as head_path, version as head_version, cast(date as varchar) as head_date from heads
        union all select 'master', arg_max(path, p), '1.' || arg_max(rn, p), cast(arg_max(date, p) as varchar) from pos""",
    "last_updated": f"""with {REV}, {OWN}
        select branch, cast(max(date) as varchar) as last_updated from own group by branch
        union all select 'master', cast(max(date) as varchar) from live""",
    "branch_log": f"""with {OWN} select path, version, cast(date as varchar) as date, 'clerk' as author, commit_id
        from own_rev where branch = 'B2'""",
    "fold_while": """with r as (
          select conv_id, turn, sum(length(text)) over (partition by conv_id order by turn) as acc from conversations),
        k as (select conv_id, acc, lag(acc, 1, 0) over (partition by conv_id order by turn) as before from r)
        select conv_id, cast(max(acc) as bigint) as folded from k where before < 500 group by conv_id""",
    "fold_while_affine": """with r as (
          select conv_id, list({'times': 1 + turn % 2, 'plus': length(text), 'total': 0::bigint} order by turn) as steps
          from conversations group by conv_id)
        select conv_id, list_reduce(list_prepend({'times': 0::bigint, 'plus': 0::bigint, 'total': 0::bigint}, steps),
                 lambda acc, x: case when acc.total < 2000
                   then {'times': 0::bigint, 'plus': 0::bigint, 'total': x.times * acc.total + x.plus} else acc end).total as folded
        from r""",
    "graft_points": f"""with {ENTRIES} select branch, parent, method, path as graft_path, version as graft_version,
        cast(date as varchar) as graft_date from placed""",
    "branch_points": f"""with {ENTRIES},
        c as (select path, '1.' || rn as version, date, commit_id from live
              union all select path, version, date, commit_id from own_rev)
        select 'B' || q.k || '.branch_point' as branch, c.path, c.version, cast(c.date as varchar) as date, c.commit_id
        from parents q join c on c.path = q.path and c.version = q.version""",
    "graft_none": f"""with {ENTRIES},
        c as (select path, '1.' || rn as version, path_depth, rn, date from live
              union all select path, version, 0, rn, date from own_rev),
        h as (select q.k, c.*, row_number() over (partition by q.k order by date desc, path_depth desc, c.path desc, rn desc) as i
              from parents q join c on c.path = q.path and c.version = q.version)
        select 'master' as branch, null as parent, 'NONE' as method, null as graft_path, null as graft_version, null as graft_date
        union all
        select 'B' || k || '.branch_point', null, 'NONE', null, null, null from h where i = 1
        union all
        select 'B' || k, 'B' || k || '.branch_point', 'BRANCH_POINT', path, version, cast(date as varchar) from h where i = 1""",
    "merge_base": f"""with {ENTRIES}, {LINEAGE},
        shared as (
          select l.branch as "left", r.branch as "right", l.ancestor, l.level,
                 case when r.p is null or l.p <= r.p then l.path else r.path end as path,
                 case when r.p is null or l.p <= r.p then l.version else r.version end as version,
                 case when r.p is null or l.p <= r.p then l.date else r.date end as date
          from chain l join chain r on r.ancestor = l.ancestor and l.branch < r.branch),
        ranked as (select *, row_number() over (partition by "left", "right" order by level desc) as i from shared)
        select "left", "right", ancestor, path as base_path, version as base_version, cast(date as varchar) as base_date
        from ranked where i = 1""",
    "branch_diff_lines": f"""with {FILES},
        was as (select * from contents where rn = 1),
        now as (select * from contents where rn = 2),
        lines as (
          select path, line, n, kind from (
            select path, unnest(string_split(text, chr(10))) as line, -1 as n, doc_id % 5 as kind from was where doc_id % 5 <> 4
            union all
            select path, unnest(string_split(text, chr(10))), 1, doc_id % 5 from now where doc_id % 5 <> 3) z)
        select 'master' as parent, 'edition' as branch, path,
               case max(kind) when 3 then 'DELETE' when 4 then 'ADD' else 'MODIFY' end as change,
               md5(line) as line_md5, cast(sum(n) as bigint) as delta
        from lines group by path, line having sum(n) <> 0""",
    "branch_diff": f"""with {ENTRIES}, {LINEAGE},
        cut as (select p from anchors where k = 1),
        base as (select path, '1.' || arg_max(rn, p) as version, arg_max(is_dead, p) as is_dead
                 from pos where p <= (select p from cut) group by path),
        hist as (select 0 as level, p, path, '1.' || rn as version, is_dead from pos where p <= (select p from cut)
                 union all select k, p, path, version, is_dead from own_pos where k in (1, 2)),
        tip as (select path, arg_max(version, (level, p)) as version, arg_max(is_dead, (level, p)) as is_dead from hist group by path),
        a as (select path, version from base where not is_dead),
        b as (select path, version from tip where not is_dead)
        select 'B3' as parent, 'B2' as branch, coalesce(a.path, b.path) as path,
               case when a.path is null then 'ADD' when b.path is null then 'DELETE' else 'MODIFY' end as change,
               a.version as old_version, b.version as new_version
        from a full outer join b on b.path = a.path where a.version is distinct from b.version""",
    "branch_snapshot": f"""with {ENTRIES}, {LINEAGE}, {HISTORY}
        select branch, path, version from spans where next_path is null and not is_dead""",
    "branch_live_counts": f"""with {ENTRIES}, {LINEAGE}, {HISTORY},
        counted as (
          select *, sum(was_dead::int - is_dead::int) over (
                   partition by branch order by level, date, path_depth, path, rn rows unbounded preceding) as n from spans)
        select branch, path, version, cast(date as varchar) as date, cast(n as bigint) as live_files
        from counted where branch = ancestor""",
    "branch_intervals": f"""with {ENTRIES}, {LINEAGE}, {HISTORY}
        select branch, ancestor, path, version, is_dead, cast(date as varchar) as date,
               next_level, next_path, next_version, cast(next_date as varchar) as next_date
        from spans where branch <> 'master'""",
    "snapshots_at": f"""with {ENTRIES}, {LINEAGE}, {HISTORY},
        points as (
          select 'T' || k as name, 'master' as branch, 0 as level, o.date, o.path_depth, o.path, o.rn
          from anchors a join pos o on o.p = a.p
          union all
          select e.branch || ' ' || e.path || ' ' || version, e.branch, c.level, e.date, path_depth, e.path, rn
          from everything e join (select branch, max(level) as level from chain group by branch) c on c.branch = e.branch
          where cast(commit_id as bigint) % 40 = 0),
        states as (
          select p.name, s.path || ' ' || s.version as entry
          from spans s join points p on p.branch = s.branch
          where not s.is_dead and (s.level, s.date, s.path_depth, s.path, s.rn) <= (p.level, p.date, p.path_depth, p.path, p.rn)
            and (s.next_path is null
                 or (s.next_level, s.next_date, s.path_depth, s.next_path, s.next_rn) > (p.level, p.date, p.path_depth, p.path, p.rn)))
        select name, count(*) as n_files, {digest_sql("entry")} as files from states group by name""",
    "merge_base_commits": f"""with {ENTRIES}, {LINEAGE}, {HISTORY},
        picked as (
          select branch, path, path_depth, rn, version, date,
                 lag(branch) over w as lb, lag(path) over w as lp, lag(path_depth) over w as ld, lag(rn) over w as lr,
                 lag(version) over w as lv, lag(date) over w as lt
          from everything where cast(commit_id as bigint) % 20 = 0
          window w as (order by cast(commit_id as bigint), branch, path)),
        own_cap as (select *, row_number() over (partition by branch order by level desc) = 1 as is_own from cap),
        both_caps as (
          select p.*, l.ancestor, l.level,
                 case when l.is_own then (lt, ld, lp, lr, lv) else (l.date::timestamp, l.cap_depth, l.path, l.cap_rn, l.version) end as a,
                 case when r.is_own then (p.date, p.path_depth, p.path, p.rn, p.version) else (r.date::timestamp, r.cap_depth, r.path, r.cap_rn, r.version) end as b
          from picked p join own_cap l on l.branch = lb join own_cap r on r.branch = p.branch and r.ancestor = l.ancestor),
        ranked as (select *, least(a, b) as c, row_number() over (
                     partition by lb, lp, lv, branch, path, version order by level desc) as i from both_caps)
        select lb as left_branch, lp as left_path, lv as left_version, cast(lt as varchar) as left_date,
               branch as right_branch, path as right_path, version as right_version, cast(date as varchar) as right_date,
               ancestor, c[3] as base_path, c[5] as base_version, cast(c[1] as varchar) as base_date
        from ranked where i = 1""",
    "tree_ids": f"""with {ENTRIES}, {LINEAGE}, {HISTORY},
        point as (select branch, level, date, path_depth, path, rn, version from full_history where branch = ancestor),
        held as (
          select p.branch, p.path as at_path, p.version as at_version, p.date as at_date,
                 string_split(s.path, '/') as parts, s.version as id
          from spans s join point p on p.branch = s.branch
          where not s.is_dead and (s.level, s.date, s.path_depth, s.path, s.rn) <= (p.level, p.date, p.path_depth, p.path, p.rn)
            and (s.next_path is null
                 or (s.next_level, s.next_date, s.path_depth, s.next_path, s.next_rn) > (p.level, p.date, p.path_depth, p.path, p.rn))),
        inner_trees as (
          select branch, at_path, at_version, at_date, parts[1] as d, parts[2] || '/tree/' || {digest_sql("parts[3] || '/file/' || id")} as entry
          from held where len(parts) = 3 group by branch, at_path, at_version, at_date, parts[1], parts[2]),
        outer_trees as (
          select branch, at_path, at_version, at_date, d || '/tree/' || {digest_sql("entry")} as entry
          from (select * from inner_trees union all
                select branch, at_path, at_version, at_date, parts[1], parts[2] || '/file/' || id from held where len(parts) = 2) z
          group by branch, at_path, at_version, at_date, d),
        roots as (
          select branch, at_path, at_version, at_date, {digest_sql("entry")} as tree_id, count(*) as n_entries
          from (select * from outer_trees union all
                select branch, at_path, at_version, at_date, parts[1] || '/file/' || id from held where len(parts) = 1) z
          group by branch, at_path, at_version, at_date)
        select p.branch, p.path as commit_path, p.version as commit_version, cast(p.date as varchar) as commit_date,
               tree_id, coalesce(n_entries, 0) as n_entries
        from point p left join roots r on r.branch = p.branch and r.at_path = p.path and r.at_version = p.version and r.at_date = p.date""",
    "snapshot_diff": f"""with {FILES},
        a as (select path, blob_id from contents where rn = 1), b as (select path, blob_id from contents where rn = 2)
        select coalesce(a.path, b.path) as path, a.blob_id as old_id, b.blob_id as new_id,
               case when a.path is null then 'ADD' when b.path is null then 'DELETE' else 'MODIFY' end as change
        from a full outer join b on b.path = a.path where a.blob_id is distinct from b.blob_id""",
    "line_delta": f"with {FILES}, {LINES} select path, md5(line) as line_md5, delta from delta",
    "line_totals": f"""with {FILES}, {LINES}
        select path, cast(sum(greatest(delta, 0)) as bigint) as added, cast(sum(greatest(-delta, 0)) as bigint) as removed
        from delta group by path""",
    "dir_rollup": f"""with {REV}, {HEAD_FILES},
        up as (select unnest(list_transform(range(0, len(string_split(path, '/'))),
                 lambda i: array_to_string(string_split(path, '/')[1:i], '/'))) as dir, length(commit_id) as n from head_live)
        select dir, count(*) as n_files, cast(sum(n) as bigint) as n_bytes from up group by dir""",
    "dir_digests": f"""with recursive {REV}, {HEAD_FILES},
        deep as (select replace(path, '/s', '/x/y/z/s') as path, version from head_live),
        f as (select len(string_split(path, '/')) - 1 as level,
                     case when path like '%/%' then regexp_replace(path, '/[^/]*$', '') else '' end as dir,
                     string_split(path, '/')[-1] || '/file/' || version as e from deep),
        t as (
          select max(level) + 1 as level, null::varchar as dir, null::varchar as id, 0::bigint as n_entries from f
          union all
          select level - 1, dir, {digest_sql("e")}, count(*) from (
            select level, case when dir like '%/%' then regexp_replace(dir, '/[^/]*$', '') else '' end as dir,
                   string_split(dir, '/')[-1] || '/tree/' || id as e from t where dir <> ''
            union all
            select f.level + 1, f.dir, f.e from f join (select distinct level from t) l on f.level + 1 = l.level) z
          group by level, dir)
        select dir, id, n_entries from t where dir is not null""",
    "dir_entries": f"""with {REV}, {HEAD_FILES}
        select distinct string_split(path, '/')[2] as name,
               case when len(string_split(path, '/')) > 2 then 'tree' else 'file' end as mode
        from head_live where path like 'd1/%'""",
    "import_trunk": f"""with {REV},
        n as (select *, lag(path) over w as pp, lag(rn) over w as pr, lag(date) over w as pd from live
              window w as (order by date, path_depth, path, rn))
        select 'refs/remotes/cvs/master' as ref, {VERSION}, author, author || '@nowhere.com' as mail, comment as message,
               {NOTE} || 'CVS_COMMIT_ID: ' || commit_id || chr(10) as note,
               pp as parent_path, '1.' || pr as parent_version, cast(pd as varchar) as parent_date from n""",
    "import_summary": f"""with {ENTRIES},
        c as (select 'master' as branch, path, is_dead, date from live union all select branch, path, is_dead, date from own),
        g as (select branch, count(*) as n_commits, count(*) filter (is_dead) as n_dead, count(distinct path) as n_files,
                     cast(min(date) as varchar) as first_date, cast(max(date) as varchar) as last_date from c group by branch)
        select p.branch, p.parent, p.method, n_commits, n_dead, n_files,
               case when p.branch = 'master' then (select count(*) from noise) + (select count(*) from own_head) else 0 end as n_noise,
               first_date, last_date
        from placed p join g on g.branch = p.branch""",
    "incremental_import": f"with {PARTS} select {VERSION}, commit_id from fresh",
    "reimport_bound": f"""with {PARTS}, {OWN},
        early as (select date, path_depth, path, rn from live where date < timestamp '2024-01-15'
                  order by date desc, path_depth desc, path desc, rn desc limit 1)
        select 'master' as branch, l.path, '1.' || l.rn as version, cast(l.date as varchar) as date from live l, early h
        where (l.date, l.path_depth, l.path, l.rn) > (h.date, h.path_depth, h.path, h.rn)
        union all select branch, path, version, cast(date as varchar) from own_rev""",
    "import_twice": f"with {REV} select {VERSION}, commit_id from live",
    "late_rows": f"""with {PARTS} select {VERSION}, commit_id from live l
        where not exists (select 1 from old o where o.path = l.path and o.rn = l.rn)
          and not exists (select 1 from fresh o where o.path = l.path and o.rn = l.rn)""",
    "only_new": f"""with {OWN} select branch, min(date) >= timestamp '1995-01-10' as is_new from own group by branch""",
    "branch_set_ops": f"""with {OWN}
        select distinct branch as name, 'union' as kind from own
        union all select 'master', 'union' union all select 'master', 'difference'""",
    "stream_import": f"""with {PARTS},
        arrived as (
          select *, case when rn = 1 and is_dead then 'noise'
                         when exists (select 1 from old o where o.path = r.path and o.rn = r.rn)
                           or exists (select 1 from fresh o where o.path = r.path and o.rn = r.rn) then 'commit' else 'late' end as kind
          from rev r)
        select kind, {VERSION}, commit_id from arrived""",
}
