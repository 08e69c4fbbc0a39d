"""ANSI SQL for the registered queries, written against the given tables directly.

None of it reads entry documents: the answers come straight from the star tables. The delta is
spelled out as the sequence of deletes and inserts it stands for, not as the closed form.
"""

from __future__ import annotations

_ENTRY_NAMES = """
  select 'P' || p_partkey as primary_accession, 'ID_' || p_partkey as entry_name from part
  union all
  select 'D' || doc_id, 'DOC_' || doc_id from documents"""

_PROTEINS = """
  select 'P' || p_partkey as primary_accession, 'ID_' || p_partkey as entry_name,
         case when p_type <> 'PROMO' then p_name end as protein_name, p_size as ncbi_taxid,
         cast(length(p_name) as integer) as sequence_length, p_size as molecular_weight,
         date '1998-02-03' as created_date, date '2021-11-05' as modified_date
  from part
  union all
  select 'D' || doc_id, 'DOC_' || doc_id, null, null, cast(n_chars as integer), null,
         date '2005-06-07', date '2022-01-09'
  from documents"""

_TAXONOMY = """
  select p_size as ncbi_taxid, p_type as scientific_name, p_type || ' > ' || p_brand as lineage
  from (select *, row_number() over (partition by p_size order by p_partkey) as rn from part) t
  where rn = 1"""

_GO = """
  select 'P' || p_partkey as protein_accession, 'GO:N' || p_size as go_term_id
  from part where p_type in ('SMALL', 'LARGE')
  union all
  select 'P' || p_partkey, 'GO:' || p_size from part where p_type in ('ECONOMY', 'LARGE')"""

_ACCESSIONS = """
  select 'P' || p_partkey as protein_accession, 'S' || p_partkey as secondary_accession
  from part where p_type in ('ECONOMY', 'SMALL')"""

_GENES = """
  select 'P' || p_partkey as protein_accession, p_brand as gene_name, true as is_primary from part
  union all
  select 'P' || p_partkey, p_type, false from part
  union all
  select 'D' || doc_id, source, true from documents"""

_KEYWORDS = """
  select 'P' || p_partkey as protein_accession, 'K' || p_size as keyword_id, p_type as keyword_label from part
  union all
  select 'D' || doc_id, 'L-' || lang, lang from documents"""

_COMMENTS = """
  select 'P' || p_partkey as primary_accession,
         case when p_size <= 25 then 'function' else 'miscellaneous' end as comment_type,
         'about ' || p_name as comment_text,
         case when p_type in ('SMALL', 'LARGE') then 'GO:N' || p_size end as nested_id
  from part
  union all
  select 'D' || doc_id, case when lang = 'en' then 'function' else 'caution' end, text, null from documents"""

_COUNTS = "select 'part' as dataset, count(*) as n_entries from part union all select 'documents', count(*) from documents"

# Live tables (p*) and next release (s*), then the merge step by step.
_RELEASE = """
 with pp as (select o_orderkey acc,
               case when not (o_orderstatus = 'F' and o_orderpriority = '4-NOT SPECIFIED') then o_orderkey end uid,
               o_orderstatus nm, o_totalprice v
             from orders where o_orderstatus in ('F', 'O')),
  st as (select *, case when o_orderstatus = 'O' and o_orderpriority = '1-URGENT' then -o_orderkey - 1
                   else o_orderkey end acc
         from orders where o_orderstatus = 'P' or o_orderpriority <> '5-LOW'),
  sp as (select acc,
               case when o_orderstatus = 'O' and o_orderpriority = '2-HIGH' then -o_orderkey - 1
                    when not (o_orderstatus = 'F' and o_orderpriority = '4-NOT SPECIFIED') then o_orderkey end uid,
               'new' nm, o_totalprice + 1 v
         from st),
  li as (select l_orderkey, l_linenumber ln, min(l_returnflag) flag from lineitem group by 1, 2),
  pc as (select l_orderkey acc, ln, flag from li join pp on l_orderkey = pp.acc
         where flag <> 'N' or l_orderkey in (select o_orderkey from orders where o_orderpriority = '5-LOW')),
  sc as (select st.acc, ln, 'Z' flag from li join st on l_orderkey = o_orderkey where flag <> 'R' or o_orderstatus = 'P'),
  ps as (select o_orderkey acc, o_orderpriority seq from orders where o_orderstatus in ('F', 'O')),
  ss as (select acc, 'next-' || o_orderpriority seq from st where o_orderstatus <> 'F'),
  pt as (select c_custkey taxid, c_name name, c_mktsegment lineage from customer where c_acctbal < 5000),
  sx as (select c_custkey taxid, 'next-' || c_name name, c_mktsegment lineage from customer where c_acctbal >= 2000),
  moved as (select distinct p.acc from pp p join sp s on p.uid = s.uid where p.acc <> s.acc),
  p1 as (select * from pp where not exists (select 1 from moved m where m.acc = pp.acc)),
  p2 as (select s.acc, s.uid, case when o.acc is null then s.nm else o.nm end nm, s.v
         from sp s left join p1 o on s.acc = o.acc
         union all
         select * from p1 where not exists (select 1 from sp s where s.acc = p1.acc)),
  p3 as (select * from p2 where exists (select 1 from sp s where s.uid = p2.uid)),
  q1 as (select * from ps where not exists (select 1 from moved m where m.acc = ps.acc)),
  q2 as (select * from ss union all select * from q1 where not exists (select 1 from ss where ss.acc = q1.acc)),
  q3 as (select * from q2 where exists (select 1 from p3 where p3.acc = q2.acc)),
  k1 as (select * from pc where not exists (select 1 from moved m where m.acc = pc.acc)),
  k2 as (select * from k1 where not (exists (select 1 from sp where sp.acc = k1.acc)
          and not exists (select 1 from sc where sc.acc = k1.acc and sc.ln = k1.ln))),
  k3 as (select * from k2
         union all
         select * from sc where not exists (select 1 from k2 where k2.acc = sc.acc and k2.ln = sc.ln)),
  k4 as (select * from k3 where exists (select 1 from p3 where p3.acc = k3.acc)),
  class as (select coalesce(p.uid, s.uid) uid, p.acc old_key, s.acc new_key,
              case when p.uid is null then 'NEW' when s.uid is null then 'REMOVED'
                   when p.acc <> s.acc then 'REKEYED' else 'UPDATED' end as change
            from (select * from pp where uid is not null) p
            full join (select * from sp where uid is not null) s on p.uid = s.uid)
"""

_SYNC = """
  select * from pc where not exists (select 1 from sp where sp.acc = pc.acc)
     or exists (select 1 from sc where sc.acc = pc.acc and sc.ln = pc.ln)
  union all
  select * from sc where not exists (select 1 from pc where pc.acc = sc.acc and pc.ln = sc.ln)"""

_VERSION = "strftime(o_orderdate, '%Y_%m')"
_DATE_TEXT = (
    "case when o_orderstatus = 'F' then strftime(o_orderdate, '%d/%m/%Y') else strftime(o_orderdate, '%d-%b-%Y') end"
)
_DATE = "case when o_orderstatus <> 'F' then cast(o_orderdate as date) end"
_SWISS = "cast(case when o_orderpriority = '4-NOT SPECIFIED' then 0 else o_custkey + 1000 end as integer)"
_TREMBL = "cast(case when o_orderpriority = '4-NOT SPECIFIED' then 0 else o_orderkey + 1000000 end as integer)"


def _named(condition: str) -> str:
    return f"select * from ({_ENTRY_NAMES}) n where primary_accession in ({condition})"


# Rows of the published tables after a load of both datasets, or of parts only.
def _table_counts(proteins: str, taxa: str, accessions: str, genes: str, go: str) -> str:
    rows = {
        "taxonomy": taxa, "proteins": proteins, "sequences": proteins, "accessions": accessions,
        "genes": genes, "keywords": proteins, "protein_to_go": go, "release_metadata": "select 1",
    }
    return " union all ".join(f"select '{name}' as table_name, count(*) as n_rows from ({sql}) t" for name, sql in rows.items())


def _part_counts(parts: str, taxa: str) -> str:
    return _table_counts(
        f"select 1 from part where {parts}",
        f"select distinct p_size from part where {taxa}",
        f"select 1 from part where p_type in ('ECONOMY', 'SMALL') and {parts}",
        f"select 1 from part where {parts} union all select 1 from part where {parts}",
        f"select 1 from part where p_type in ('SMALL', 'LARGE') and {parts} "
        f"union all select 1 from part where p_type in ('ECONOMY', 'LARGE') and {parts}",
    )


# Rows of the two releases of the delta by key, compared as sets: what a merge does to each table.
_LIVE_AND_NEXT = {
    "proteins": ("select 'P' || p_partkey as k from part where p_size <= 40", "select 'P' || p_partkey as k from part where p_size >= 10", "updated"),
    "taxonomy": ("select distinct p_size as k from part where p_size <= 40", "select distinct p_size as k from part where p_size >= 10", "updated"),
    "accessions": (
        "select 'S' || p_partkey as k from part where p_type in ('ECONOMY', 'SMALL') and p_size <= 40",
        "select 'S' || p_partkey as k from part where p_type in ('ECONOMY', 'SMALL') and p_size >= 10",
        "kept",
    ),
    "genes": (
        "select p_partkey || ' ' || unnest([p_brand, p_type]) as k from part where p_size <= 40",
        "select p_partkey || ' ' || unnest([reverse(p_brand), p_type]) as k from part where p_size >= 10",
        "kept",
    ),
    "keywords": ("select p_partkey as k from part where p_size <= 40", "select p_partkey as k from part where p_size >= 10", "kept"),
    "protein_to_go": tuple(
        " union all ".join(
            f"select p_partkey || '{prefix}' as k from part where p_type in {types} and p_size {condition}"
            for prefix, types in ((" N", "('SMALL', 'LARGE')"), ("", "('ECONOMY', 'LARGE')"))
        )
        for condition in ("<= 40", ">= 10")
    )
    + ("kept",),
}
_LIVE_AND_NEXT["sequences"] = _LIVE_AND_NEXT["proteins"]


def _row_counts(table: str, live: str, staged: str, again: str) -> str:
    both = f"(select count(*) from (({live}) intersect ({staged})) x)"
    gone = f"(select count(*) from (({live}) except ({staged})) x)"
    new = f"(select count(*) from (({staged}) except ({live})) x)"
    # Organisms are never removed.
    kept, deleted = (gone, "0") if table == "taxonomy" else (both if again == "kept" else "0", gone)
    updated = both if again == "updated" else "0"
    return f"""
      select '{table}' as table_name, cast({new} as bigint) as inserted, cast({updated} as bigint) as updated,
             cast({kept} as bigint) as kept, cast({deleted} as bigint) as deleted"""


_ROW_COUNTS = " union all ".join(_row_counts(table, *sides) for table, sides in _LIVE_AND_NEXT.items())

ORACLES: dict[str, str] = {
    "scan_entries_count": _COUNTS,
    "scan_then_shred_genes": _GENES,
    "scan_commented_entries": "select 'D' || doc_id as primary_accession, text || ' </entry>' as comment_text from documents",
    "dataset_union_counts": _COUNTS,
    "shred_proteins": _PROTEINS,
    "shred_sequences": """
      select * from (
        select 'P' || p_partkey as primary_accession, p_name || p_brand as sequence from part
        union all
        select 'D' || doc_id, replace(text, chr(10), '') from documents) t
      where sequence <> ''""",
    "shred_accessions": _ACCESSIONS,
    "shred_taxonomy": _TAXONOMY,
    "shred_genes": _GENES,
    "shred_keywords": _KEYWORDS,
    "shred_go": _GO,
    "json_tree_comments_full": _COMMENTS,
    "json_tree_comments_standard": f"""
      select primary_accession,
             case when comment_type = 'function' then comment_type end as comment_type,
             case when comment_type = 'function' then comment_text end as comment_text,
             case when comment_type = 'function' then nested_id end as nested_id,
             true as others_missing
      from ({_COMMENTS}) c""",
    "json_tree_features": """
      select 'P' || p_partkey as primary_accession, p_name as description, cast(p_size as varchar) as position,
             case when p_size > 10 then 'ECO:' || p_size end as evidence_type,
             case when p_size > 10 then p_brand end as evidence_source
      from part
      union all
      select 'D' || doc_id, null, null, null, null from documents""",
    "json_tree_db_references": """
      select 'P' || p_partkey as primary_accession, cast(1 as integer) as n_references,
             cast(p_partkey as varchar) as reference_id, p_type as property_value
      from part
      union all
      select 'D' || doc_id, null, null, null from documents""",
    "json_validity": "select event_id, 'props' as column_name from events where event_type = 'error'",
    "json_tree_validity": f"select primary_accession, cast(0 as integer) as n_invalid from ({_ENTRY_NAMES}) n",
    "malformed_entries": """
      select doc_id, contains(text, '&') or contains(text, '<') as malformed from documents""",
    "incomplete_documents": """
      select distinct 'documents' as dataset, cast(doc_id // 50 as bigint) as document, cast(0 as bigint) as closed_tails
      from documents where doc_id // 50 % 3 = 0""",
    "json_tree_prefixed": "select 'D' || doc_id as primary_accession, 'text' as kind from documents",
    "duplicate_keys": """
      select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1""",
    "null_keys": _RELEASE + "select acc, uid from sp where acc is null or uid is null",
    "length_violations": """
      select doc_id, 'text' as column_name, cast(length(text) as integer) as value_length
      from documents where length(text) > 4000
      union all
      select doc_id, 'source', cast(length(source) as integer) from documents where length(source) > 4""",
    "fk_orphans": _RELEASE + """
      select l_orderkey, count(*) as n_rows from lineitem
      where l_orderkey is not null and not exists (select 1 from pp where pp.acc = l_orderkey) group by 1""",
    "entry_violations": """
      select 'D' || doc_id as primary_accession, 'genes' as table_name, 'gene_name longer than 255' as problem
      from documents where length(text) > 255""",
    "dedup_keep_first_part": """
      select p_size, p_partkey, p_name, p_type
      from (select *, row_number() over (partition by p_size order by p_partkey) as rn from part) t where rn = 1""",
    "dedup_keep_first_lineitem": """
      select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag
      from (select *, row_number() over (partition by l_orderkey, l_linenumber
              order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag) as rn from lineitem) t
      where rn = 1""",
    "dedup_counts": """
      select cast(sum(n) as bigint) as n_rows, count(*) as n_keys, cast(sum(n - 1) as bigint) as n_removed
      from (select count(*) as n from lineitem group by l_orderkey, l_linenumber) t""",
    "verify_checksums": """
      select 'lang=' || lang as release, source || '-' || (doc_id // 5000) || '.gz' as filename,
             case when lang = 'de' then 'unlisted' when source = 'src1' then 'mismatch' else 'valid' end as status
      from documents group by lang, source, doc_id // 5000""",
    "delta_changed_keys": _RELEASE + "select acc from moved",
    "delta_removed_keys": _RELEASE
    + "select acc from pp where not exists (select 1 from sp s where s.uid = pp.uid)",
    "delta_rekey_delete": _RELEASE + "select * from p1",
    "delta_classify": _RELEASE + "select * from class",
    "delta_report": _RELEASE + "select change, count(*) as n_keys from class group by 1",
    "delta_proteins": _RELEASE + "select * from p3",
    "delta_proteins_scoped": _RELEASE
    + """select * from p2 where exists (select 1 from sp s where s.uid = p2.uid)
           or (nm <> 'F' and not exists (select 1 from sp s where s.acc = p2.acc))""",
    "delta_sequences": _RELEASE + "select * from q3",
    "delta_children": _RELEASE + "select * from k4",
    "delta_children_refreshed": _RELEASE
    + """select acc, ln, case when exists (select 1 from sc where sc.acc = k4.acc and sc.ln = k4.ln)
           then 'Z' else flag end as flag from k4""",
    "delta_taxonomy": _RELEASE
    + "select * from sx union all select * from pt where not exists (select 1 from sx where sx.taxid = pt.taxid)",
    "upsert_partial": _RELEASE
    + """select s.acc, s.uid, case when o.acc is null then s.nm else o.nm end nm, s.v
         from sp s left join pp o on s.acc = o.acc
         union all
         select * from pp where not exists (select 1 from sp s where s.acc = pp.acc)""",
    "insert_ignore": _RELEASE
    + """select * from pc union all
         select * from sc where not exists (select 1 from pc where pc.acc = sc.acc and pc.ln = sc.ln)""",
    "sync_children": _RELEASE + _SYNC,
    "cascade_delete": _RELEASE + "select * from k1",
    "delete_removed": _RELEASE
    + """select * from pc where exists (select 1 from pp join sp on pp.uid = sp.uid where pp.acc = pc.acc)""",
    "release_date": f"""
      select cast(o_orderkey as varchar) as release, {_VERSION} as version,
             {_DATE_TEXT} as release_date_text, {_DATE} as release_date
      from orders""",
    "release_counts": f"""
      select cast(o_orderkey as varchar) as release, {_SWISS} as swissprot_entry_count,
             {_TREMBL} as trembl_entry_count
      from orders""",
    "release_catalog": f"""
      select cast(o_orderkey as varchar) as release, {_VERSION} as version, {_DATE} as release_date,
             {_DATE_TEXT} as release_date_text, {_SWISS} as swissprot_entry_count, {_TREMBL} as trembl_entry_count
      from orders""",
    "manifest_parse": """
      select 'part-' || p_partkey || '.xml.gz' as filename, md5(p_name || p_partkey) as md5
      from part where p_type <> 'PROMO'""",
    "latest_release": f"select {_VERSION} as version from orders order by o_orderdate desc, 1 desc limit 1",
    "history_in_order": """
      select cast(event_id as varchar) as run_id,
             case when event_type = 'error' then 'FAILED' else 'COMPLETED' end as status, ts as start_time
      from events""",
    "reconcile_counts": """
      select 'part' as dataset, count(*) as n_declared, count(*) as n_loaded, true as matches from part
      union all
      select 'documents', count(*), count(*) filter (where not contains(text, '&') and not contains(text, '<')),
             count(*) = count(*) filter (where not contains(text, '&') and not contains(text, '<'))
      from documents""",
    "lookup_entry_name": f"""
      select primary_accession, entry_name, protein_name from ({_PROTEINS}) p where entry_name in ('ID_7', 'DOC_11')""",
    "proteins_of_taxon": f"""
      select primary_accession, p.ncbi_taxid, scientific_name, lineage
      from ({_PROTEINS}) p join ({_TAXONOMY}) t on p.ncbi_taxid = t.ncbi_taxid""",
    "taxon_counts": f"""
      select t.ncbi_taxid, scientific_name, lineage, n_proteins
      from ({_TAXONOMY}) t join (select p_size, count(*) as n_proteins from part group by 1) c on c.p_size = t.ncbi_taxid""",
    "resolve_accession": """
      select 'P' || p_partkey as accession, 'P' || p_partkey as primary_accession, true as is_current from part
      union all
      select 'S' || p_partkey, 'P' || p_partkey, false from part where p_type in ('ECONOMY', 'SMALL')""",
    "lookup_gene": _named(f"select protein_accession from ({_GENES}) g where gene_name = 'SMALL'"),
    "lookup_gene_primary": _named(
        f"select protein_accession from ({_GENES}) g where gene_name = 'Brand#7' and is_primary"
    ),
    "lookup_keyword": _named(f"select protein_accession from ({_KEYWORDS}) k where keyword_label = 'fr'"),
    "lookup_go": _named(f"select protein_accession from ({_GO}) g where go_term_id = 'GO:N12'"),
    "json_contains_comments": f"""
      select primary_accession, comment_type = 'function' as has_function from ({_COMMENTS}) c""",
    "json_contains_nested": """
      select 'P' || p_partkey as primary_accession, p_size <= 25 and p_type in ('SMALL', 'LARGE') as has_go_comment,
             p_size = 17 as has_evidence, p_size = 12 as begins_at_12
      from part
      union all
      select 'D' || doc_id, false, false, false from documents""",
    "published_lookups": f"""
      with found as (
        select 'gene' as lookup, protein_accession as primary_accession from ({_GENES}) g where gene_name = 'Brand#7' and is_primary
        union all
        select 'keyword', protein_accession from ({_KEYWORDS}) k where keyword_label = 'fr'
        union all
        select 'go', protein_accession from ({_GO}) t where go_term_id = 'GO:N12'
        union all
        select 'accession', primary_accession from ({_ENTRY_NAMES}) n where primary_accession in ('P7', 'D11'))
      select lookup, primary_accession, entry_name, n_residues
      from found join ({_ENTRY_NAMES}) n using (primary_accession)
      join (select 'P' || p_partkey as primary_accession, cast(length(p_name || p_brand) as integer) as n_residues from part
            union all
            select 'D' || doc_id, cast(nullif(length(replace(text, chr(10), '')), 0) as integer) from documents) s using (primary_accession)""",
    "published_json_lookup": """
      select 'P' || p_partkey as primary_accession, 'ID_' || p_partkey as entry_name, pattern
      from part join (values ('go_comment'), ('evidence'), ('begin')) p(pattern)
        on case pattern when 'go_comment' then p_size <= 25 and p_type in ('SMALL', 'LARGE') when 'evidence' then p_size = 17 else p_size = 12 end""",
    "json_field_props": "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events",
    "tsv_roundtrip_customer": """
      select c_custkey, c_name, nullif(case when c_mktsegment = 'MACHINERY' then '' else c_mktsegment end, '')
               as c_mktsegment, c_acctbal < 0 as in_debt
      from customer""",
    "tsv_roundtrip_documents": """
      select doc_id, ' "' || text || '"' || chr(9) || chr(10) as text, lang from documents""",
    "row_differences": _RELEASE
    + """select *, 'left' as side from (select * from pc except all select * from sc) a
         union all
         select *, 'right' from (select * from sc except all select * from pc) b""",
    "load_full_counts": _table_counts(
        _ENTRY_NAMES,
        "select distinct p_size from part",
        _ACCESSIONS,
        _GENES,
        _GO,
    ),
    "load_release_metadata": """
      select '2025_01' as version, date '2025-09-01' as release_date,
             cast((select count(*) from part) as integer) as swissprot_entry_count,
             cast((select count(*) from documents) as integer) as trembl_entry_count""",
    "load_delta_proteins": """
      select 'P' || p_partkey as primary_accession, 'ID_' || p_partkey as entry_name,
             case when p_type = 'PROMO' then null when p_size <= 40 then p_name else p_name || ' v2' end as protein_name,
             cast(length(p_name) + 3 as integer) as sequence_length, p_name || ' v2' || reverse(p_brand) as sequence
      from part where p_size >= 10""",
    "load_delta_accessions": f"select * from ({_ACCESSIONS} and p_size >= 10) t",
    "load_delta_genes": """
      select 'P' || p_partkey as protein_accession, reverse(p_brand) as gene_name, true as is_primary from part where p_size >= 10
      union all
      select 'P' || p_partkey, p_type, false from part where p_size >= 10""",
    "load_delta_keywords": """
      select 'P' || p_partkey as protein_accession, 'K' || p_size as keyword_id, p_type as keyword_label
      from part where p_size >= 10""",
    "load_delta_protein_to_go": f"""
      select g.* from ({_GO}) g join part on protein_accession = 'P' || p_partkey where p_size >= 10""",
    "load_delta_taxonomy": """
      select p_size as ncbi_taxid, p_type as scientific_name,
             p_type || ' > ' || case when p_size >= 10 then reverse(p_brand) else p_brand end as lineage
      from (select *, row_number() over (partition by p_size order by p_partkey) as rn from part) t where rn = 1""",
    "load_delta_counts": _part_counts("p_size >= 10", "p_size > 0"),
    "load_delta_row_counts": _ROW_COUNTS,
    "load_bookkeeping": """
      with n as (select count(*) as all_parts, count(*) filter (where p_size <= 40) as small from part)
      select 'COMPLETED' as status, 'full' as mode, 'part' as dataset, all_parts as n_declared, all_parts as n_loaded,
             2 * all_parts as genes_inserted from n
      union all
      select 'FAILED', 'delta', 'part', null, null, null from n
      union all
      select 'FAILED', 'delta', 'part', null, null, null from n""",
    "snapshot_of_version": f"""
      select *, '2025_01' as version from ({_part_counts("p_size <= 40", "p_size <= 40")}) a
      union all
      select *, '2025_02' from ({_part_counts("p_size >= 10", "p_size > 0")}) b""",
    "releases_live_at": """
      with published as (
        select row_number() over (order by o_orderdate, o_orderkey) as seq, strftime(o_orderdate, '%Y_%m') as version,
               o_orderdate as published_at, lead(o_orderdate) over (order by o_orderdate, o_orderkey) as replaced_at
        from orders where o_orderkey % 1000 = 0)
      select event_id, seq, version
      from events left join published on ts >= published_at and (replaced_at is null or ts < replaced_at)""",
    "load_rollback_counts": _part_counts("p_size <= 40", "p_size <= 40"),
}
