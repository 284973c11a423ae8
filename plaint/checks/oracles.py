"""The SQL beside each query, over the same tables, for another engine (DuckDB)."""

from __future__ import annotations

from plaint.checks.queries import ABSENT, DAY, SELECTED, START, TOP
from plaint.functions.color import PALETTE

# Named parts; each lists the parts it needs.
_RAW = """
with histories as (
  select event_id % (select greatest(count(*), 1) from documents) as doc_id,
    arg_min(ts, event_id) as opened, arg_min(event_type, event_id) as event_type,
    arg_min(user_id, event_id) as user_id, max(ts) as touched
  from events group by 1
)
select d.doc_id,
  case when d.doc_id % 97 = 13 then '' when d.doc_id % 101 = 7 then null
       else 'T' || lpad(d.doc_id::varchar, 7, '0') end as ticket_id,
  d.source as type, 'Org-' || d.lang as organization, d.text as comment,
  case when d.doc_id % 5 = 0 then '' when d.doc_id % 7 = 0 then null
       else 'http://img.example.com/' || d.doc_id::varchar || '.jpg' end as photo,
  null::varchar as photo_after,
  case when d.doc_id % 89 = 3 then '100.5' when d.doc_id % 83 = 5 then 'n/a,13.7'
       when d.doc_id % 79 = 11 then null
       else '100.' || (300 + d.doc_id % 601)::varchar || ',13.'
            || (500 + (d.doc_id * 7) % 401)::varchar end as coords,
  'Addr ' || d.doc_id::varchar as address,
  'S' || (d.doc_id % 180)::varchar as subdistrict, 'D' || (d.doc_id % 50)::varchar as district,
  'Bangkok' as province, e.opened::varchar || '+00' as "timestamp", e.event_type as state,
  case when d.doc_id % 6 = 0 then null else (d.doc_id % 6)::varchar end as star,
  (e.user_id % 3)::varchar as count_reopen, e.touched::varchar || '+00' as last_activity
from documents d left join histories e on e.doc_id = d.doc_id
"""

_CLEAN = r"""regexp_replace(replace(comment, '"', ''), '[\r\n\x{85}\x{2028}\x{2029}]+', ' ', 'g')"""

_TYPED = """
  try_cast(replace("timestamp", '+00', '') as timestamp) as "timestamp", state,
  try_cast(star as integer) as star, try_cast(count_reopen as integer) as count_reopen,
  try_cast(replace(last_activity, '+00', '') as timestamp) as last_activity"""

_COORDS = """
  try_cast(nullif(split_part(coords, ',', 1), '') as double) as longitude,
  try_cast(nullif(split_part(coords, ',', 2), '') as double) as latitude"""

_TICKETS = f"""
select ticket_id, type, organization, {_CLEAN} as comment, photo, photo_after, address,
  subdistrict, district, province, {_TYPED}, {_COORDS}, doc_id
from raw
"""

_GIVEN = """
select vec_id as doc_id, embedding::double[] as vector, (label + 1)::varchar as cluster
from embeddings
"""

_MEANS = """
select cluster, list(m order by i) as mean
from (select cluster, i, avg(v) as m
      from (select cluster, generate_subscripts(vector, 1) as i, unnest(vector) as v from {0})
      group by all)
group by cluster
"""

_COMPONENTS = """
select cluster::int as c,
  list_transform(mean, lambda x: x / sqrt(list_sum(list_transform(mean, lambda y: y * y)))) as axis
from means where cluster::int <= 3
"""

_SCORES = """
select g.doc_id, max(case when c = 1 then s end) as "PC1", max(case when c = 2 then s end) as "PC2",
  max(case when c = 3 then s end) as "PC3"
from (select doc_id, c,
        list_sum(list_transform(list_zip(vector, axis), lambda z: z[1] * z[2])) as s
      from given cross join components) g
group by g.doc_id
"""

_PALETTE = f"""
select cluster, position, [{", ".join(map(str, PALETTE))}][least(position, 9) + 1] as color
from (select cluster, (row_number() over (order by cluster) - 1)::int as position
      from (select distinct cluster from given))
"""

# Trigrams of code points, and byte values, as the default embedders count them.
_WORDS = r"""
select doc_id, list(coalesce(n, 0) / l order by pos) as text_vector
from (select doc_id, unnest(range(64)) as pos from tickets)
  left join (
    select doc_id, pos, count(*) as n
    from (select doc_id,
            unnest(list_transform(range(1, len(cp) - 1),
              lambda i: (cp[i]::bigint * 961 + cp[i + 1] * 31 + cp[i + 2]) % 64)) as pos
          from (select doc_id, list_transform(
                    regexp_extract_all(' ' || coalesce(comment, '') || ' ', '(?s).'),
                    lambda c: unicode(c)) as cp
                from tickets))
    group by all) using (doc_id, pos)
  join (select doc_id, greatest(sqrt(sum(n * n)), 1e-300) as l from (
          select doc_id, pos, count(*) as n
          from (select doc_id,
                  unnest(list_transform(range(1, len(cp) - 1),
                    lambda i: (cp[i]::bigint * 961 + cp[i + 1] * 31 + cp[i + 2]) % 64)) as pos
                from (select doc_id, list_transform(
                          regexp_extract_all(' ' || coalesce(comment, '') || ' ', '(?s).'),
                          lambda c: unicode(c)) as cp
                      from tickets))
          group by all) group by doc_id) using (doc_id)
group by doc_id
"""

_PICTURES = """
select url, list(coalesce(n, 0) / l order by pos) as image_vector
from (select url, unnest(range(64)) as pos from photos)
  left join (select url, b // 4 as pos, count(*) as n from bytes group by all) using (url, pos)
  join (select url, sqrt(sum(n * n)) as l
        from (select url, b // 4 as pos, count(*) as n from bytes group by all)
        group by url) using (url)
group by url
"""

_REASON = """
  case when ticket_id is null or ticket_id = '' then 'missing ticket_id'
       when photo is null or photo = '' then 'missing photo'
       when content is null or octet_length(content) = 0 then 'photo not available' end"""

_COMPLETE = """
select doc_id, ticket_id, "timestamp",
  list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) as vector
from (select t.doc_id, ticket_id, "timestamp", list_concat(text_vector, image_vector) as v
      from guarded t join words using (doc_id) join pictures on url = photo
      where reject_reason is null)
"""

_PARTS: dict[str, tuple[str, list[str]]] = {
    "raw": (_RAW, []),
    "tickets": (_TICKETS, ["raw"]),
    "given": (_GIVEN, []),
    "means": (_MEANS.format("given"), ["given"]),
    "components": (_COMPONENTS, ["means"]),
    "scores": (_SCORES, ["given", "components"]),
    "vectors": ("select t.*, vector, cluster from tickets t join given using (doc_id)", ["tickets", "given"]),
    "vector_means": (_MEANS.format("vectors"), ["vectors"]),
    "clustered": (
        "select t.*, cluster from tickets t left join (select doc_id, cluster from given) using (doc_id)",
        ["tickets", "given"],
    ),
    "scored": (
        'select t.*, "PC1", "PC2", "PC3" from clustered t left join scores using (doc_id)',
        ["clustered", "scores"],
    ),
    "dashboard": (
        "select ticket_id as id, * exclude (ticket_id) from scored",
        ["scored"],
    ),
    "palette": (_PALETTE, ["given"]),
    "photos": (
        "select 'http://img.example.com/' || page_id::varchar || '.jpg' as url, encode(html) as content"
        " from pages",
        [],
    ),
    "bytes": (
        "select url, ('0x' || unnest(regexp_extract_all(hex(content), '..')))::int as b from photos",
        ["photos"],
    ),
    "words": (_WORDS, ["tickets"]),
    "pictures": (_PICTURES, ["bytes"]),
    "guarded": (
        f"select t.*, content, {_REASON} as reject_reason from tickets t left join photos on url = photo",
        ["tickets", "photos"],
    ),
    "complete": (_COMPLETE, ["guarded", "words", "pictures"]),
}


def _needs(names: list[str]) -> list[str]:
    """The parts and all that they need, each after its own needs."""
    found: list[str] = []
    for name in names:
        for part in [*_needs(_PARTS[name][1]), name]:
            if part not in found:
                found.append(part)
    return found


def _with(names: str, body: str) -> str:
    parts = ", ".join(f"{name} as ({_PARTS[name][0]})" for name in _needs(names.split()))
    return f"with {parts} {body}"


def _cells(keys: str, vector: str, source: str) -> str:
    """One row per element of a vector."""
    return (
        f"select {keys}, pos::int as pos, round(value, 6) + 0.0::double as value from (select {keys},"
        f" unnest(range(len({vector}))) as pos, unnest({vector}) as value from ({source}))"
    )


def _score(name: str) -> str:
    return f'round("{name}", 6) + 0.0::double as "{name}"'


_SCORED = ", ".join(map(_score, ["PC1", "PC2", "PC3"]))
_TICKET_COLUMNS = (
    "ticket_id, type, organization, comment, photo, photo_after, address, subdistrict, district,"
    ' province, "timestamp", state, star, count_reopen, last_activity, longitude, latitude'
)
# The raw format has one sign for NULL and for '', an empty field.
_LANDED_COLUMNS = _TICKET_COLUMNS.replace(
    "ticket_id,", "nullif(ticket_id, '') as ticket_id,"
).replace(" photo,", " nullif(photo, '') as photo,")
_IN = f"try_cast(cluster as integer) in ({', '.join(map(str, SELECTED))})"
_SAMPLE = "row_number() over (partition by cluster order by md5('42:' || doc_id::varchar), doc_id)"
_COLOR = "array_to_string(coalesce(color, [128, 128, 128, 255]), ',')"
_RGBA = (
    "'rgba(' || {0} || {s} || {1} || {s} || {2} || {s} || ({3} / 255.0)::double::varchar || ')'"
)


def _rgba(color: str, separator: str) -> str:
    return _RGBA.format(*[f"({color})[{i}]" for i in range(1, 5)], s=f"'{separator}'")


def _text(markup: str) -> str:
    """Text of an element of the test pages, whose references are few. HTML reads these names also
    without the semicolon, as in a title that was cut."""
    space = r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]*"
    untagged = rf"regexp_replace({markup}, '(?s)<!--.*?-->|<[^>]*>', chr(1), 'g')"
    for name, char in [("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")]:
        untagged = f"regexp_replace({untagged}, '&{name};?', '{char}', 'g')"
    joined = rf"regexp_replace({untagged}, '{space}\x01{space}', '', 'g')"
    trimmed = rf"regexp_replace({joined}, '^{space}|{space}$', '', 'g')"
    return f"coalesce({trimmed}, '')"


def _element(markup: str, tag: str) -> str:
    pattern = rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"
    return f"regexp_extract_all({markup}, '{pattern}', 1)[1]"


_ITEMS = f"""
select page_id, position::int as position, {_text(_element("item", "a"))} as time,
  {_text(_element("item", "p"))} as description
from (select page_id, unnest(range(len(items))) as position, unnest(items) as item
      from (select page_id,
              regexp_extract_all(html, '(?is)<li(?:\\s[^>]*)?>(.*?)</li\\s*>', 1) as items
            from pages))
"""

_SPACES = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]*"

# What the lists of the derived news pages hold, by their kind.
_NEWS = rf"""
select page_id, unnest(range(len(items)))::int as position, unnest(items)[1] as time,
  unnest(items)[2] as description
from (
  select doc_id as page_id, case doc_id % 4
    when 0 then [[n, d], [n || 'b', ''], ['', '']]
    when 1 then [[n, d], ['in', d], ['', 'last']]
    when 2 then [[n, d], ['nextendbold', 'endbold'], ['', 'endbold']]
    else [[n || d, d]] end as items
  from (select doc_id, 'N' || doc_id as n,
          regexp_replace(coalesce(text, ''), '^{_SPACES}|{_SPACES}$', '', 'g') as d
        from documents))
"""

_CENTRAL = """
select cluster, arg_min(coalesce(comment, ''), (d, k)) as summary
from (select v.cluster, comment, {key} as k,
        round(sqrt(list_sum(list_transform(list_zip(vector, mean),
          lambda z: (z[1] - z[2]) * (z[1] - z[2])))), 9) as d
      from {vectors} v join {means} m on m.cluster = v.cluster)
group by cluster
"""

_PC_SUMMARY = """
pc as (select id, cluster, comment, ["PC1", "PC2", "PC3"] as vector from dashboard
       where cluster is not null),
pc_means as (select cluster, [avg("PC1"), avg("PC2"), avg("PC3")] as mean from dashboard
             where cluster is not null group by cluster)
"""

_LAST_SAMPLE = _with(
    "clustered",
    f"""
    select cluster, trim(regexp_replace('- ' || coalesce(comment, ''), '(?s)^.*\n', '')) as summary
    from (select *, {_SAMPLE} as position,
            least(count(*) over (partition by cluster), 10) as last
          from clustered where cluster is not null)
    where position = last""",
)

_BOX = """
select district, min(longitude) as x1, max(longitude) as x2, min(latitude) as y1, max(latitude) as y2
from tickets group by district
"""

ORACLES: dict[str, str] = {
    # Scans and sources
    "read_ticket_csv": _with(
        "raw",
        """select * exclude (doc_id)
          replace (nullif(ticket_id, '') as ticket_id, nullif(photo, '') as photo) from raw""",
    ),
    "read_tickets": _with(
        "tickets", f"select {_TICKET_COLUMNS} from tickets where \"timestamp\"::date = date '{DAY}'"
    ),
    "read_tickets_since": _with(
        "tickets", f"select {_TICKET_COLUMNS} from tickets where \"timestamp\" >= timestamp '{START}'"
    ),
    "dashboard_scan": _with(
        "dashboard",
        f"""select id, comment, address, photo, latitude, longitude, last_activity, cluster, {_SCORED}
        from dashboard order by last_activity desc nulls last, md5('tie:' || coalesce(id, '')), id
        limit {TOP}""",
    ),
    "load_processed_csv": _with("tickets", f"select {_TICKET_COLUMNS} from tickets"),
    "read_outlines": _with(
        "tickets",
        f"""select district as name,
          array_to_string(list_transform([0, 1, 2, 3], lambda i:
            150 + ('0x' || substr(md5(district), 1 + 6 * i, 6))::int % 106), ',') as color,
          (unnest(range(5)))::int as pos, unnest([x1, x2, x2, x1, x1]) as lon,
          unnest([y1, y1, y2, y2, y1]) as lat
        from ({_BOX})""",
    ),
    "extract_list_items": _ITEMS,
    "news_list_items": _NEWS,
    "attach_photo_bytes": _with(
        "tickets photos",
        """select doc_id, coalesce(octet_length(content), 0)::int as bytes,
          md5(coalesce(content, ''::blob)) as digest
        from tickets left join photos on url = photo""",
    ),
    "fetch_photos": _with(
        "tickets", "select distinct photo as url, photo as content from tickets where photo <> ''"
    ),
    # Sinks
    "append_tickets": _with(
        "tickets",
        f"select {_TICKET_COLUMNS}, 'fixture' as landed, \"timestamp\"::date as day from tickets",
    ),
    "append_vectors": _with("vectors", _cells("address", "vector", "select * from vectors")),
    "publish_clustered": _with("scored", f"select {_TICKET_COLUMNS}, cluster, {_SCORED} from scored"),
    # Projections
    "type_tickets": _with(
        "raw",
        f"""select ticket_id, type, organization, comment, photo, photo_after, coords, address,
          subdistrict, district, province, {_TYPED}, doc_id from raw""",
    ),
    "clean_text": _with("raw", f"select doc_id, {_CLEAN} as comment from raw"),
    "split_coords": _with("raw", f"select doc_id, {_COORDS} from raw"),
    "transform_tickets": _with("tickets", "select * from tickets"),
    "rename_columns": _with(
        "dashboard",
        f"""select id, comment, address, photo, latitude, longitude, last_activity, cluster, {_SCORED},
          doc_id from dashboard""",
    ),
    "clustered_columns": _with(
        "scored", f"select {_TICKET_COLUMNS}, doc_id, cluster, {_SCORED} from scored"
    ),
    "vector_rows": _with(
        "vectors", _cells("ticket_id", "vector", "select * from vectors where ticket_id <> ''")
    ),
    # Filters
    "day_filter": _with(
        "tickets",
        f"select doc_id, ticket_id from tickets where \"timestamp\"::date = date '{DAY}'",
    ),
    "since_filter": _with(
        "tickets",
        f"select doc_id, ticket_id from tickets where \"timestamp\" >= timestamp '{START}'",
    ),
    "has_value": _with(
        "tickets",
        "select doc_id, ticket_id, photo from tickets where photo <> '' and ticket_id <> ''",
    ),
    "not_blank_keep_null": _with(
        "tickets",
        """select doc_id, ticket_id, photo from tickets
        where photo is distinct from '' and ticket_id is distinct from ''""",
    ),
    "id_present": _with("tickets", "select doc_id, ticket_id from tickets where ticket_id <> ''"),
    "filter_clusters": _with("clustered", f"select doc_id, cluster from clustered where {_IN}"),
    "filter_clusters_fallback": _with(
        "clustered",
        f"""select doc_id, cluster from clustered
        where cluster::int in ({ABSENT[0]})
          or not exists (select 1 from clustered where cluster::int in ({ABSENT[0]}))""",
    ),
    "embed_guard": _with("guarded", "select doc_id, reject_reason from guarded"),
    # Joins
    "join_vectors": _with(
        "vectors",
        _cells(
            "doc_id, ticket_id",
            "vector",
            """select t.doc_id, ticket_id, vector
            from (select doc_id, ticket_id from tickets where photo <> '' and ticket_id <> '') t
              join (select ticket_id, vector from vectors) using (ticket_id)""",
        ),
    ),
    "join_clusters_components": _with(
        "vectors scored",
        f"""select v.doc_id, v.ticket_id, c.cluster, {_SCORED}
        from vectors v
          left join (select ticket_id, cluster from scored
                     where cluster is not null and ticket_id <> '') c using (ticket_id)
          left join (select ticket_id, "PC1", "PC2", "PC3" from scored
                     where cluster is not null and ticket_id <> '') p using (ticket_id)""",
    ),
    "assign_clusters": _with(
        "vectors means",
        """select doc_id, arg_min(cluster, (d, cluster::int)) as cluster
        from (select doc_id, m.cluster,
                round(list_sum(list_transform(list_zip(vector, mean),
                  lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 9) as d
              from vectors v cross join means m)
        group by doc_id""",
    ),
    "color_points": _with(
        "clustered palette",
        f"select doc_id, cluster, {_COLOR} as color from clustered left join palette using (cluster)",
    ),
    # Aggregations
    "cluster_counts": _with(
        "clustered",
        """select cluster, count(*) as "count" from clustered where cluster is not null
        group by cluster""",
    ),
    "order_counts": _with(
        "clustered",
        """select cluster, count(*) as "count" from clustered where cluster is not null
        group by cluster order by 2 desc, 1""",
    ),
    "distinct_clusters": _with(
        "clustered", "select distinct cluster from clustered where cluster is not null order by 1"
    ),
    "distinct_clusters_int": _with(
        "clustered",
        "select distinct cluster::int as cluster from clustered where cluster is not null order by 1",
    ),
    "map_center": _with(
        "clustered",
        """select round(median(latitude), 9) + 0.0::double as latitude,
          round(median(longitude), 9) + 0.0::double as longitude from clustered""",
    ),
    "map_center_selected": _with(
        "clustered",
        f"""select round(median(latitude), 9) + 0.0::double as latitude,
          round(median(longitude), 9) + 0.0::double as longitude from clustered where {_IN}""",
    ),
    "map_counts": _with(
        "clustered",
        f"""select least(count(*) filter (where {_IN}), 100000)::bigint as shown_points,
          count(*) as total_points, {len(SELECTED)}::bigint as selected_clusters,
          count(distinct cluster) as total_clusters from clustered""",
    ),
    "map_counts_fallback": _with(
        "clustered",
        f"""select least(count(*), {TOP})::bigint as shown_points, count(*) as total_points,
          {len(ABSENT)}::bigint as selected_clusters, count(distinct cluster) as total_clusters
        from clustered""",
    ),
    "cluster_samples": _with(
        "clustered",
        f"""select cluster, string_agg(coalesce(comment, ''), ' | ' order by position) as comments
        from (select *, {_SAMPLE} as position from clustered where cluster is not null)
        where position <= 10 group by cluster""",
    ),
    "cluster_prompt": _with(
        "clustered",
        f"""select cluster, 'Summarise:' || chr(10) || chr(10)
          || string_agg('- ' || coalesce(comment, ''), chr(10) order by position) as prompt
        from (select *, {_SAMPLE} as position from clustered where cluster is not null)
        where position <= 10 group by cluster""",
    ),
    "cluster_means": _with(
        "means vectors",
        """select cluster, (i - 1)::int as pos, round(avg(v), 6) + 0.0::double as value
        from (select cluster, generate_subscripts(vector, 1) as i, unnest(vector) as v from vectors)
        group by all""",
    ),
    # Samples, orders and limits
    "sample_per_group": _with(
        "clustered",
        f"""select cluster, position::int as position, doc_id
        from (select *, {_SAMPLE} as position from clustered where cluster is not null)
        where position <= 10""",
    ),
    "sample_per_group_shown": _with(
        "clustered",
        f"""select cluster, position::int as position, doc_id
        from (select *, {_SAMPLE} as position from clustered where cluster is not null)
        where position <= 3""",
    ),
    "sample_n": _with(
        "tickets",
        f"""select doc_id, ticket_id from tickets
        order by md5('42:' || doc_id::varchar), doc_id limit {TOP}""",
    ),
    "newest": _with(
        "tickets",
        f"""select doc_id, ticket_id, last_activity from tickets
        order by last_activity desc nulls last, md5('tie:' || coalesce(ticket_id, '')), ticket_id
        limit {TOP}""",
    ),
    "cap_rows": _with(
        "tickets",
        """select doc_id, ticket_id, "timestamp" from tickets
        order by "timestamp" nulls last, ticket_id nulls last limit 20""",
    ),
    # Scalar functions
    "text_functions": _with(
        "raw",
        f"""select doc_id, {_CLEAN} as cleaned,
          coalesce(substr(comment, 1, 200), '') || '…' as short_comment,
          '- ' || {_CLEAN} as bullet,
          coalesce(photo, '') as photo, split_part(coords, ',', 1) as first_part,
          case when contains(coords, ',') then split_part(coords, ',', 2) end as second_part
        from raw""",
    ),
    "typed_values": _with(
        "raw",
        """select doc_id, try_cast(replace("timestamp", '+00', '') as timestamp) as moment,
          try_cast(replace(last_activity, '+00', '') as timestamp)::date as day,
          try_cast(star as integer) as star,
          try_cast(split_part(coords, ',', 1) as double) as longitude,
          case when not contains(coords, ',') then trunc(try_cast(coords as double))::int end
            as not_whole,
          try_cast(count_reopen as integer)::varchar as reopened
        from raw""",
    ),
    "palette": _with(
        "palette",
        f"""select cluster, position, array_to_string(color, ',') as color,
          {_rgba("color", ",")} as rgba,
          printf('#%02x%02x%02x', color[1], color[2], color[3]) as hex from palette""",
    ),
    "name_color": _with(
        "tickets",
        """select doc_id, address, array_to_string(list_transform([0, 1, 2, 3], lambda i:
          150 + ('0x' || substr(md5(address), 1 + 6 * i, 6))::int % 106), ',') as color
        from tickets""",
    ),
    "element_text": f"""select page_id, {_text(_element("html", "title"))} as title,
          {_text(_element("html", "footer"))} as footer, {_text(_element("html", "h4"))} as missing
        from pages""",
    "concat_vectors": _with(
        "vectors",
        _cells("doc_id", "vector", "select doc_id, list_concat(vector, vector) as vector from vectors"),
    ),
    "l2_normalize": _with(
        "vectors",
        _cells(
            "doc_id",
            "vector",
            """select doc_id, list_transform(vector, lambda x:
              x / sqrt(list_sum(list_transform(vector, lambda y: y * y)))) as vector from vectors""",
        ),
    ),
    # Vector building
    "embed_text": _with("words", _cells("doc_id", "text_vector", "select * from words")),
    "embed_image": _with("pictures", _cells("url", "image_vector", "select * from pictures")),
    "combine_vectors": _with(
        "words given",
        _cells(
            "doc_id",
            "vector",
            """select doc_id, list_transform(v, lambda x:
                x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) as vector
            from (select doc_id, list_concat(text_vector, vector) as v
                  from words join given using (doc_id))""",
        ),
    ),
    "vectorize_tickets": _with("complete", _cells("doc_id", "vector", "select * from complete")),
    "vectorize_rejects": _with(
        "guarded", "select doc_id, reject_reason from guarded where reject_reason is not null"
    ),
    "given_components": _with(
        "vectors scores",
        _cells(
            "doc_id",
            "vector",
            'select doc_id, ["PC1", "PC2", "PC3"] as vector from scores join tickets using (doc_id)',
        ),
    ),
    "component_norms": _with(
        "vectors",
        """, middle as (
          select list(m order by i) as mean
          from (select i, avg(v) as m
                from (select generate_subscripts(vector, 1) as i, unnest(vector) as v from vectors)
                group by i))
        select doc_id, round(list_sum(list_transform(list_zip(vector, mean),
          lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 6) + 0.0::double as squares
        from vectors cross join middle""",
    ),
    "summarize_clusters": _with(
        "vector_means", _CENTRAL.format(key="doc_id", vectors="vectors", means="vector_means")
    ),
    "summarize_with_callable": _LAST_SAMPLE,
    # Whole jobs and reports
    "daily_ingest": _with("tickets", f"select {_LANDED_COLUMNS} from tickets"),
    "daily_export": _with("tickets", f"select {_LANDED_COLUMNS} from tickets"),
    "daily_vectorize": _with(
        "complete",
        _cells(
            "ticket_id",
            "vector",
            f"select * from complete where \"timestamp\"::date = date '{DAY}'",
        ),
    ),
    "predict_clusters": _with(
        "vectors", "select doc_id, coalesce(ticket_id <> '', false) as clustered, true as nearest from vectors"
    ),
    "fit_kmeans": "select (i + 1)::varchar as cluster, true as used, true as central from range(8) t(i)",
    "load_model": _with("vectors", "select doc_id, true as same from vectors"),
    "project_components": _with(
        "vectors",
        """select doc_id, case when ticket_id <> '' then 3 else 0 end as scores,
          true as projected from vectors""",
    ),
    "fit_pca": """select (i + 1)::int as component, true as unit, true as orthogonal,
      true as ordered from range(3) t(i)""",
    "daily_vectorize_late": _with("complete", _cells("ticket_id", "vector", "select * from complete")),
    "backfill_twice": _with("complete", _cells("ticket_id", "vector", "select * from complete")),
    "backfill_after_daily": _with("complete", _cells("ticket_id", "vector", "select * from complete")),
    "vectorize_repeat_empty": _with(
        "complete",
        f"""select count(*) as written, 0::bigint as written_again, 0::bigint as left_over
          from complete where "timestamp"::date = date '{DAY}'""",
    ),
    "run_metrics": _with(
        "guarded",
        """select count(*) as fetched, count(*) filter (reject_reason is null) as written,
          count(*) filter (reject_reason is not null) as rejected
        from guarded where coalesce(photo, 'x') <> '' and coalesce(ticket_id, 'x') <> ''""",
    ),
    "repeated_photo_urls": _with("complete", _cells("doc_id", "vector", "select * from complete")),
    "embed_in_batches": _with("words", _cells("doc_id", "text_vector", "select * from words")),
    "land_raw": """select (doc_id % 7)::int as part, concat_ws(',', doc_id, lang, source) as value
      from documents""",
    "either_field": """select page_id, case when page_id % 2 = 0 then '' else url end as time,
      case when page_id % 3 = 0 then '' else url end as description
      from pages where page_id % 6 <> 0""",
    "newest_one_hour": _with(
        "tickets",
        f"""select count(*) as rows, min(moment) as oldest
        from (select timestamp '2024-01-01' + to_milliseconds(doc_id // 5) as moment
              from tickets order by 1 desc limit {TOP})""",
    ),
    "map_center_infinite": _with(
        "tickets",
        """select round(median(case doc_id % 10 when 0 then 'inf'::double when 1 then '-inf'::double
          when 2 then 1e308 else latitude end), 9) + 0.0::double as latitude from tickets""",
    ),
    "stream_two_sources": _with(
        "tickets", f"select {_LANDED_COLUMNS} from tickets cross join range(2)"
    ),
    "backfill_vectors": _with("complete", _cells("ticket_id", "vector", "select * from complete")),
    "refresh_clusters": _with(
        "vectors",
        f"""select {_TICKET_COLUMNS}, len(vector)::int as width,
          coalesce(ticket_id <> '', false) as clustered,
          case when ticket_id <> '' then 3 else 0 end as scores from vectors""",
    ),
    "refresh_clusters_nearest": _with(
        "vectors",
        """select address, coalesce(ticket_id <> '', false) as clustered, true as nearest,
          true as projected from vectors""",
    ),
    "map_center_sketch": "select unnest(['latitude', 'longitude']) as name, true as within",
    "cluster_report_bars": _with(
        "clustered palette",
        """select cluster, "count", printf('#%02x%02x%02x', color[1], color[2], color[3]) as bar_color
        from (select cluster, count(*) as "count" from clustered where cluster is not null
              group by cluster) join palette using (cluster) order by 2 desc, 1""",
    ),
    "cluster_report_scatter": _with(
        "dashboard palette",
        f"""select id, cluster, {_SCORED},
          {_rgba("coalesce(color, [128, 128, 128, 255])", ",")} as color
        from dashboard left join palette using (cluster)""",
    ),
    "cluster_report_samples": _with("dashboard palette", "").rstrip()
    + f""", {_PC_SUMMARY}, central as ({_CENTRAL.format(key="id", vectors="pc", means="pc_means")}),
    shown as (
      select cluster, string_agg('- ' || coalesce(comment, ''), chr(10) order by position) as comments
      from (select *, row_number() over (partition by cluster
              order by md5('42:' || address), address) as position
            from dashboard where cluster is not null)
      where position <= 3 group by cluster)
    select cluster, {_rgba("color", ", ")} as color, summary, comments
    from shown join central using (cluster) join palette using (cluster)""",
    "map_report_points": _with(
        "dashboard palette",
        f"""select id, latitude, longitude, cluster, {_COLOR} as color,
          coalesce(substr(comment, 1, 200), '') || '…' as short_comment, photo, address
        from (select * from dashboard where {_IN}
              order by md5('42:' || address), address limit {TOP})
          left join palette using (cluster)""",
    ),
    "map_report_center": _with(
        "clustered",
        f"""select round(median(latitude), 9) + 0.0::double as latitude,
          round(median(longitude), 9) + 0.0::double as longitude from clustered where {_IN}""",
    ),
    "map_report_counts": _with(
        "clustered",
        f"""select least(count(*) filter (where {_IN}), 100000)::bigint as shown_points,
          count(*) as total_points, {len(SELECTED)}::bigint as selected_clusters,
          count(distinct cluster) as total_clusters from clustered""",
    ),
    "traffic_items": f"select * from ({_ITEMS}) where time <> '' or description <> ''",
    "news_traffic_items": f"select * from ({_NEWS}) where time <> '' or description <> ''",
    "stream_then_vectorize": _with("complete", _cells("ticket_id", "vector", "select * from complete")),
    "stream_ingest": _with("tickets", f"select {_LANDED_COLUMNS} from tickets"),
}
