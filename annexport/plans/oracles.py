"""The registered queries as plain SQL over the same tables, for checking results."""

from __future__ import annotations

from annexport.plans.queries import (
    CATALOG_SIZE,
    EXCLUDED,
    OTHER_OWNER,
    OWNER,
    REGISTERED,
    SCAN_RANGES,
    TABLES,
    TABLESPACES,
    TEMPORARY,
    VIEWS,
)

TIME = "'%Y-%m-%d %H:%M:%S'"

# String columns of the test tables, as the table descriptions list them.
TEXT_COLUMNS = {
    "region": ("r_name",),
    "nation": ("n_name",),
    "customer": ("c_name", "c_mktsegment"),
    "supplier": ("s_name",),
    "part": ("p_name", "p_brand", "p_type"),
    "orders": ("o_orderstatus", "o_orderpriority"),
    "lineitem": ("l_returnflag", "l_linestatus"),
    "events": ("event_type", "props"),
    "documents": ("text", "lang", "source"),
    "pages": ("url", "html"),
    "benchmark": ("text",),
    "conversations": ("role", "text"),
}


def _names(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


LABELS = f"""
labels_of as (
  select distinct l_orderkey, p_size <= {CATALOG_SIZE} as is_catalog,
         case when p_size <= {CATALOG_SIZE} then {{label}} else s_name end as label
  from lineitem left join part on p_partkey = l_partkey left join supplier on s_suppkey = l_suppkey
)"""

MANIFEST = f"""
with {LABELS.format(label="p_name")},
parts as (
  select l_orderkey,
         string_agg(label, '|' order by label) filter (where is_catalog) as catalog_items,
         string_agg(label, '|' order by label) filter (where not is_catalog) as other_items
  from labels_of where label is not null group by l_orderkey
)
select o_orderkey as order_id, strftime(o_orderdate, {TIME}) as order_date, c_name as contact,
       concat_ws('|', catalog_items, other_items) as items
from orders join customer on c_custkey = o_custkey left join parts on l_orderkey = o_orderkey
"""

MANIFEST_CSV = f"""
with {LABELS.format(label="p_name || ',\"' || p_brand")},
quoted as (
  select l_orderkey, is_catalog, label,
         case when regexp_matches(label, '[,"\\r\\n]|^\\s') then '"' || replace(label, '"', '""') || '"'
              else label end as field
  from labels_of where label is not null
),
parts as (
  select l_orderkey, string_agg(field, ',' order by is_catalog desc, label) as items
  from quoted group by l_orderkey
)
select o_orderkey as order_id,
       concat_ws(',', strftime(o_orderdate, {TIME}), c_name, items) as line
from orders join customer on c_custkey = o_custkey left join parts on l_orderkey = o_orderkey
"""

WITH_LINE_ENDS = """
ends as (
  select doc_id, lang, replace(text || chr(10), chr(10),
         case lang when 'en' then chr(13) || chr(10) when 'fr' then chr(13) else chr(10) end) as text
  from documents
)"""

NORMALISED = r"""
regexp_replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '\n\z', '')"""

TEXT_COLUMNS_EXPORT = """
select cast(d.doc_id as varchar) as "DOC_ID",
       coalesce(text, '') as "BODY",
       coalesce(case when quality = 1 then source end, '') as "ORIGIN"
from documents d left join labels using (doc_id)
where text is not null or (quality = 1 and source is not null)
"""


def _statistics(tables) -> str:
    return " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, count({c}) as non_null, "
        f"coalesce(max(length({c})), 0) as max_length from {t}"
        for t in tables if t in TEXT_COLUMNS
        for c in TEXT_COLUMNS[t]
    )


COUNTS = " union all ".join(
    f"select '{t}' as table_name, count(*) as num_rows, "
    f"'{'Y' if t in TEMPORARY else 'N'}' as temporary from {t}"
    for t in TABLES
)

VIEW_ROWS = " union all ".join(f"select '{v}' as mview_name" for v in VIEWS)

GFF3_LINES = """
lines as (
  select '/genomes/' || replace(p_brand, '#', '_') || '.v1.gff3' as file, p_partkey as id,
    case p_size
      when 50 then '###'
      when 49 then '## Dbxref=GeneID:' || p_partkey
      when 48 then p_brand || chr(9) || 'Dbxref' || chr(9) || 'polypeptide'
      when 47 then ''
      else concat_ws(chr(9), p_brand, p_type,
        case p_partkey % 4 when 0 then 'polypeptide' when 1 then 'gene' else 'mRNA' end,
        p_partkey + 1, p_partkey + 1 + p_size, '.',
        case p_partkey % 2 when 0 then '+' else '-' end, '.',
        'ID=P' || p_partkey || case p_partkey % 6
          when 0 then ';Dbxref=GeneID:' || p_partkey
          when 1 then ';Dbxref=GeneID:' || p_partkey || ',SGD:' || p_partkey || ';Name=' || p_name
          when 2 then ';Dbxref=SGD:' || p_partkey
          when 3 then ';Name=' || p_name
          when 4 then ';Dbxref=GeneID:' || p_partkey || ',NCBI_GP:' || p_partkey
          else ';Dbxref=SGD:1;Dbxref=GeneID:' || p_partkey end)
    end as value
  from part
)"""

CLEANED = GFF3_LINES + r""",
cut as (
  select file, id, value, string_split(value, chr(9)) as f from lines
),
attrs as (
  select *, list_filter(string_split(f[9], ';'), lambda a: starts_with(a, 'Dbxref')) as refs,
            list_filter(string_split(f[9], ';'), lambda a: not starts_with(a, 'Dbxref')) as others
  from cut
),
glued as (
  select *, array_to_string(refs, '') as dbx,
            array_to_string(list_transform(others, lambda a: a || ';'), '') as non
  from attrs
),
rest as (
  select *, list_filter(string_split(regexp_extract(dbx, 'Dbxref=(.+)', 1), ','),
                        lambda r: not (starts_with(r, 'GeneID') or starts_with(r, 'NCBI_GP'))) as kept
  from glued
),
done as (
  select *, case when not (contains(dbx, 'GeneID') or contains(dbx, 'NCBI_GP')) then dbx
                 when len(kept) = 0 then '' else 'Dbxref=' || array_to_string(kept, ',') end as refs_left
  from rest
),
cleaned as (
  select file, id,
    case when not contains(value, 'Dbxref') or len(f) < 9 then value
         else array_to_string(f[1:8], chr(9)) || chr(9) ||
              case when refs_left = '' then regexp_replace(non, ';$', '') else non || refs_left end
    end as value
  from done
)"""

SPLIT = GFF3_LINES + """,
latches as (select file, min(id) filter (where starts_with(value, '###')) as latch from lines group by file),
split as (
  select lines.file, id, value,
         (latch is null or id < latch) and not starts_with(value, '##')
         and coalesce(string_split(value, chr(9))[3], '') = 'polypeptide' as is_split
  from lines join latches on lines.file = latches.file
)"""

STEM = "regexp_extract(file, '([^/.]+)[^/]*$', 1)"

ORDER_SLICES = """
select folder, name, o_orderkey from (
  select 'finished' as folder, 'finished_canonical_core' as name, o_orderkey from orders where o_orderstatus = 'F'
  union all
  select 'open', 'open_canonical_core', o_orderkey from orders
  where o_orderstatus = 'O' and o_orderpriority = '1-URGENT' and o_totalprice < 250000
  union all
  select 'open', 'open_canonical_big', o_orderkey from orders
  where o_orderstatus = 'O' and o_orderpriority = '1-URGENT' and o_totalprice >= 250000
  union all
  select 'all', 'canonical_core', o_orderkey from orders
)
"""

LINE_SLICES = " union all ".join(
    f"select '{name}' as name, l_orderkey, l_partkey, l_suppkey from lineitem where {where}"
    for name, where in (
        ("open", "l_linestatus = 'O'"),
        ("open_returned", "l_linestatus = 'O' and l_returnflag = 'R'"),
        ("first_returned", "l_returnflag = 'R' and l_linenumber = 1"),
        (
            "first_ten",
            "l_linestatus = 'F' and l_returnflag = 'A' and l_linenumber = 1 and trunc(l_quantity) = 10",
        ),
    )
)

REPORT = " union all ".join(
    [
        f"select '{t}' as name, 'done' as status, count(*) as row_count from {t}"
        for t in (
            "documents", "conversations", "embeddings", "nation", "customer", "orders",
            "lineitem", "events", "benchmark",
        )
    ]
    + ["select 'no_text_form', 'failed', null"]
)

ORACLES: dict[str, str] = {
    "order_manifest": MANIFEST,
    "order_manifest_csv": MANIFEST_CSV,
    "order_manifest_items": f"""
        with {LABELS.format(label="p_name")}
        select o_orderkey as order_id, strftime(o_orderdate, {TIME}) as order_date, c_name as contact,
               is_catalog, label
        from orders join customer on c_custkey = o_custkey
        left join (select * from labels_of where label is not null) on l_orderkey = o_orderkey""",
    "order_manifest_file": f"select line from ({MANIFEST_CSV})",
    "order_contacts": f"""
        select o_orderkey as order_id, strftime(o_orderdate, {TIME}) as order_date,
               c_name as contact, n_name, r_name
        from orders join customer on c_custkey = o_custkey
        join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey
        order by o_orderdate, c_name, o_orderkey""",
    "order_contacts_file": f"""
        select row_number() over (order by o_orderdate, c_name, o_orderkey) as line_number,
               strftime(o_orderdate, {TIME}) || '|' || c_name || '|' || o_orderkey as value
        from orders join customer on c_custkey = o_custkey
        join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey""",
    "order_catalog_items": f"""
        select distinct l_orderkey as order_id, p_name from lineitem
        join part on p_partkey = l_partkey where p_size <= {CATALOG_SIZE}""",
    "order_other_items": f"""
        select distinct l_orderkey as order_id, s_name from lineitem
        join supplier on s_suppkey = l_suppkey
        where l_partkey not in (select p_partkey from part where p_size <= {CATALOG_SIZE})""",
    "order_other_items_by_id": f"""
        select distinct l.l_orderkey as order_id, s_name from lineitem l
        join supplier on s_suppkey = l.l_suppkey
        where l.l_linenumber not in (
          select c.l_linenumber from lineitem c join part on p_partkey = c.l_partkey
          where p_size <= {CATALOG_SIZE} and c.l_orderkey = l.l_orderkey)""",
    "entity_provenance": f"""
        select 'SUP' || printf('%07d', s_suppkey) as entity_id, s_name as created_by,
               strftime(min(l_shipdate), {TIME}) as date_created,
               strftime(max(l_shipdate), {TIME}) as date_modified
        from supplier join lineitem on l_suppkey = s_suppkey group by s_suppkey, s_name""",
    "accession_provenance": f"""
        select s_name as entity_id, 'a "b", ' || s_suppkey as created_by,
               strftime(min(l_shipdate), {TIME}) as date_created,
               strftime(max(l_shipdate), {TIME}) as date_modified
        from supplier join lineitem on l_suppkey = s_suppkey group by s_suppkey, s_name""",
    "lookup_value_misses": """
        select doc_id, count(*) as row_count from documents left join labels using (doc_id)
        where quality is null group by doc_id""",
    "lookup_misses": """
        select doc_id, count(*) as row_count from documents
        where doc_id not in (select doc_id from labels) group by doc_id""",
    "strain_phenotype": f"""
        select s.s_name as "strain_ID", c_name as phenotype,
               strftime(o_orderdate, {TIME}) as "createdOn"
        from supplier s join supplier g on g.s_name = s.s_name
        join lineitem on l_suppkey = g.s_suppkey
        left join orders on o_orderkey = l_orderkey
        left join customer on c_custkey = o_custkey and c_acctbal >= 0""",
    "described_entities": f"""
        select p_name as name, a.n_name as accession, l_returnflag as description,
               strftime(l_shipdate, {TIME}) as "createdOn", l_linestatus as "createdBy"
        from lineitem join part on p_partkey = l_partkey
        join supplier on s_suppkey = l_suppkey
        join nation t on t.n_nationkey = s_nationkey join region on r_regionkey = t.n_regionkey
        join nation a on a.n_nationkey = p_size
        where r_name = 'ASIA' order by l_shipdate nulls last, l_orderkey""",
    "described_entities_file": f"""
        select row_number() over (order by l_shipdate nulls last, l_orderkey) as line_number,
               strftime(l_shipdate, {TIME}) as value
        from lineitem join part on p_partkey = l_partkey
        join supplier on s_suppkey = l_suppkey
        join nation t on t.n_nationkey = s_nationkey join region on r_regionkey = t.n_regionkey
        join nation a on a.n_nationkey = p_size
        where r_name = 'ASIA'""",
    "long_text_export": f"""
        with {WITH_LINE_ENDS}
        select doc_id, quality as feature_type, {NORMALISED} as text
        from ends join labels using (doc_id) where text is not null""",
    "long_text_values": f"""
        with {WITH_LINE_ENDS}
        select doc_id, {NORMALISED} as text from ends where text is not null""",
    "text_columns_export": TEXT_COLUMNS_EXPORT,
    "text_columns_csv": TEXT_COLUMNS_EXPORT,
    "text_columns_renamed": f"""
        select "DOC_ID", "BODY" as "Full text", "ORIGIN" as "Origin" from ({TEXT_COLUMNS_EXPORT})""",
    "text_column_inventory": f"""
        select *, table_name || '_clob_data.csv' as output_file
        from ({_statistics(t for t in TABLES if t not in EXCLUDED)}) s
        where non_null > 0 and not exists (
          select 1 from ({VIEW_ROWS}) v where v.mview_name = s.table_name)""",
    "text_export_specs": f"""
        select table_name, string_agg(column_name, '|' order by column_name) as columns,
               table_name || '_ID' as id_column, table_name || '_clob_data.csv' as output_file
        from ({_statistics(TABLES)}) s join ({COUNTS}) c using (table_name)
        where num_rows > 0 and table_name not in ({_names(EXCLUDED)}) and not exists (
          select 1 from ({VIEW_ROWS}) v where v.mview_name = s.table_name)
        group by table_name""",
    "table_name_list": f"""
        select table_name, num_rows from ({COUNTS})
        where temporary = 'N' and table_name not in (select mview_name from ({VIEW_ROWS}))""",
    "own_space_table_names": f"""
        select table_name, num_rows from ({COUNTS}) where table_name not in ({_names(TABLESPACES)})""",
    "owned_text_columns": f"""
        select '{OWNER}' as owner, table_name, column_name
        from ({_statistics(TABLES)}) s join ({COUNTS}) c using (table_name)
        where num_rows > 0 and table_name not in ({_names(EXCLUDED)}) and not exists (
          select 1 from ({VIEW_ROWS}) v where v.mview_name = s.table_name)
        union all
        select '{OTHER_OWNER}', table_name, column_name
        from ({_statistics(("benchmark", "nation"))}) join ({COUNTS}) using (table_name) where num_rows > 0""",
    "text_export_specs_by_name": f"""
        select n.table_name, string_agg(column_name, '|' order by column_name) as columns, n.id_column,
               lower(n.table_name) || '_clob_data.csv' as output_file
        from (values ('PARAGRAPH', 'conversations', 'PARAGRAPH_NO'), ('PLASMID', 'pages', 'ID'),
              ('CVTERM', 'documents', 'CVTERM_ID')) n(table_name, kept_in, id_column)
        join ({_statistics(TABLES)}) s on s.table_name = n.kept_in
        join ({COUNTS}) c on c.table_name = n.kept_in where num_rows > 0
        group by n.table_name, n.id_column""",
    "table_name_clean": """
        select * from (
          select page_id, regexp_replace(trim(url), '[^a-zA-Z0-9_]', '', 'g') as url from pages)
        where url <> ''""",
    "composite_anti": """
        select distinct l_partkey, l_suppkey from lineitem l where not exists (
          select 1 from lineitem r where r.l_partkey = l.l_partkey
          and r.l_suppkey = l.l_suppkey and r.l_returnflag = 'R')""",
    "table_json": """
        select 'documents' as table_name, cast(to_json(d) as varchar) as json
        from (select * from documents left join labels using (doc_id)) d
        union all select 'conversations', cast(to_json(conversations) as varchar) from conversations
        union all select 'pages', cast(to_json(pages) as varchar) from pages
        union all select 'nation', cast(to_json(nation) as varchar) from nation
        union all select 'region', cast(to_json(region) as varchar) from region""",
    "listed_tables_json": """
        select 'conversations' as table_name, cast(to_json(conversations) as varchar) as json from conversations
        union all select 'pages', cast(to_json(pages) as varchar) from pages
        union all select 'nation', cast(to_json(nation) as varchar) from nation
        union all select 'region', cast(to_json(region) as varchar) from region""",
    "table_scan_partitioned": f"""
        with b as (select min(l_orderkey) lo, max(l_orderkey) hi from lineitem),
        w as (select lo, greatest(1, cast(ceil((hi - lo + 1) / {SCAN_RANGES}.0) as bigint)) as width from b)
        select cast((l_orderkey - lo) // width as integer) as id_range, count(*) as row_count,
               min(l_orderkey) as lowest_id, max(l_orderkey) as highest_id
        from lineitem, w group by 1""",
    "gff3_lines": f"""
        with {GFF3_LINES}, cut as (select *, string_split(value, chr(9)) as f from lines)
        select file, id, value, f[1] as seqid, f[2] as source, f[3] as type, f[4] as "start",
               f[5] as "end", f[6] as score, f[7] as strand, f[8] as phase, f[9] as attributes
        from cut""",
    "dbxref_clean": f"with {CLEANED} select file, id, value from cleaned",
    "gff3_split_kept": f"""
        with {SPLIT} select file, id, value, {STEM} || '_no_poly.gff3' as output
        from split where not is_split""",
    "gff3_split_poly": f"""
        with {SPLIT} select file, id, value, {STEM} || '_poly.gff3' as output
        from split where is_split
        union all
        select distinct file, -1, '##gff-version' || chr(9) || '3', {STEM} || '_poly.gff3' from lines""",
    "gff3_file_clean": f"""
        with {CLEANED}
        select {STEM} as stem, value from cleaned""",
    "gff3_file_placed": f"""
        with {CLEANED}
        select row_number() over (order by file, id) as line_number, value from cleaned""",
    "gff3_file_split": f"""
        with {SPLIT}, outputs as (
          select file, id, value, {STEM} || case when is_split then '_poly.gff3' else '_no_poly.gff3' end as output
          from split
          union all
          select distinct file, -1, '##gff-version' || chr(9) || '3', {STEM} || '_poly.gff3' from lines)
        select output, row_number() over (partition by output order by id) as line_number, value from outputs""",
    "slice_export": ORDER_SLICES,
    "slice_files": ORDER_SLICES,
    "slice_export_optional": LINE_SLICES,
    "class_slice_export": """
        select 'discoideum' as folder, name, p_partkey
        from (select p_partkey, ['canonical_noncoding', 'noncanonical_seq_center', 'noncanonical_norepred',
                                 'noncanonical_curated', 'other'][p_size % 5 + 1] as name from part)
        where name <> 'other'""",
    "visibility_split": """
        select doc_id, case when toxic = 0 then 'public' else 'private' end as visibility, text
        from documents left join labels using (doc_id)""",
    "required_violations": """
        with rows as (
          select doc_id, text, quality, toxic
          from documents left join labels using (doc_id))
        select 'doc_id' as column_name, count(*) - count(doc_id) as violations from rows
        union all select 'text', count(*) - count(text) from rows
        union all select 'quality', count(*) - count(quality) from rows
        union all select 'toxic', count(*) - count(toxic) from rows""",
    "unregistered_tables": f"""
        select * from ({_statistics(TABLES)}) where table_name not in ({_names(REGISTERED)})""",
    "export_report": REPORT,
    "table_scan_balanced": f"""
        with ids as (
          select case when l_orderkey % 4 = 0 then l_orderkey * 1000 else l_orderkey end as id from lineitem),
        placed as (select id, row_number() over (order by id) as place, count(*) over () as n from ids),
        bounds as (
          select distinct id as bound from placed
          where place % cast(ceil(n / {SCAN_RANGES}.0) as bigint) = 0)
        select cast((select count(*) from bounds where bound < id) as integer) as id_range,
               count(*) as row_count, min(id) as lowest_id, max(id) as highest_id
        from ids group by 1""",
}
ORACLES["text_export_specs_registered"] = ORACLES["text_export_specs"]
ORACLES["gff3_file_split_ordered"] = ORACLES["gff3_file_split"]
ORACLES["gff3_stream_split"] = ORACLES["gff3_file_split"]
ORACLES["order_manifest_by_id"] = f"""
    with rows as (
      select l_orderkey, case when l_partkey % 9 <> 0 then l_linenumber end as number,
             coalesce(p_size <= {CATALOG_SIZE}, false) as listed, p_name, s_name
      from lineitem left join part on p_partkey = l_partkey left join supplier on s_suppkey = l_suppkey),
    labels_of as (
      select distinct l_orderkey, true as is_catalog, p_name as label from rows where listed
      union
      select distinct l_orderkey, false, s_name from rows r
      where number not in (select number from rows c where c.listed and c.l_orderkey = r.l_orderkey)),
    parts as (
      select l_orderkey,
             string_agg(label, '|' order by label) filter (where is_catalog) as catalog_items,
             string_agg(label, '|' order by label) filter (where not is_catalog) as other_items
      from labels_of where label is not null group by l_orderkey)
    select o_orderkey as order_id, strftime(o_orderdate, {TIME}) as order_date, c_name as contact,
           concat_ws('|', catalog_items, other_items) as items
    from orders join customer on c_custkey = o_custkey left join parts on l_orderkey = o_orderkey"""
ORACLES["text_export_specs_filled"] = f"""
    select table_name, string_agg(column_name, '|' order by column_name) as columns,
           table_name || '_ID' as id_column, table_name || '_clob_data.csv' as output_file
    from ({_statistics(TABLES)}) s
    where non_null > 0 and table_name not in ({_names(EXCLUDED)}) and not exists (
      select 1 from ({VIEW_ROWS}) v where v.mview_name = s.table_name)
    group by table_name"""
