"""DuckDB SQL with the expected results of the queries in ``more``."""

from suite.inputs import with_inputs
from suite.oracles import _ORACLES, CELLS, ORDER_SITES, PER_ALT, RANK, SPLIT_KEY

_ODD = "case when pos % 5 = 0 then 'chrUn_x' when pos % 5 = 1 then 'chrNo' else contig end"
_PLAIN = r"regexp_replace(cast({} as varchar), '\.0$', '')"

_MORE = {
    "vcf_lines": f"""with s as (
  select contig, pos, ref, coalesce(list_sort(list_distinct(list(alt) filter (alt is not null))), []) as alts
  from fx_obs group by contig, pos, ref),
records as (select 1 as part, row_number() over (order by {RANK}, contig, pos, list_concat([ref], alts)) as i, concat_ws(chr(9),
    contig, pos, '.', ref, case when len(alts) > 0 then array_to_string(alts, ',') else '.' end,
    {_PLAIN.format('cast(pos % 40 as double) / 4')}, '.', concat_ws(';', concat('AC=', pos % 7),
      case when pos % 3 > 0 then concat('SC=', {_PLAIN.format('cast(pos % 64 as double) / 64')}) end,
      case when pos % 2 = 0 then 'DB' end)) as value from s),
top as (select 0 as part, i, value from (values (1, '##fileformat=VCFv4.2'),
  (2, '##INFO=<ID=AC,Number=1,Type=Integer,Description="count">'), (3, '##INFO=<ID=DB,Number=0,Type=Flag,Description="known">'),
  (4, '##INFO=<ID=SC,Number=1,Type=Float,Description="score">'), (5, '##contig=<ID=chr1,length=1000>'),
  (6, concat_ws(chr(9), '#CHROM', 'POS', 'ID', 'REF', 'ALT', 'QUAL', 'FILTER', 'INFO'))) t(i, value))
select row_number() over (order by part, i) as line, value from (select * from top union all select * from records) q""",
    "untouched_lines": """select concat_ws(chr(9), contig, pos, '.', 'A', 'C', concat(pos % 9, '.50'), 'PASS',
  concat('ZZ=', pos, ';AC=1;AC=2;SC=1e-05'), 'GT:QQ', concat('./1:', pos)) as value from fx_obs""",
    "valid_loci": f"""select * from (select {_ODD} as contig, pos from fx_obs) q
where contig = 'chrUn_x' or (contig not in ('chrNo', 'chrY') and pos between 1 and 300000)""",
    "bed_intervals": """select contig, start0, end0, target from fx_bed
where start0 % 6 not in (1, 2, 3) and end0 > start0""",
    "header_edits": """with base as (select concat('F', p_partkey) as id, p_name as description from part),
edited as (
  select id, 'String' as type, description from base where id not in ('F0', 'F1', 'F2', 'F3')
  union all select * from (values ('F1', 'Float', 'new text'), ('NEW', 'Integer', 'added')) t
  union all select id, 'String', concat('other ', description, ' [stamp]') from base where id in ('F0', 'F2', 'F3')),
more as (select case when length(id) % 2 = 0 then concat(id, 'x') else id end as id, 'String' as type, description from base)
select 'INFO' as section, id, '.' as number, type, description from (
  select * from edited union all select * from more where id not in (select id from edited)) q""",
    "header_csq": """with names as (select list(n_name order by n_nationkey) as l from nation)
select cast(i as int) as place, case when i = 0 then 'Allele' else l[i] end as name,
  concat('Format: Allele|', array_to_string(l, '|')) as description from (select l, unnest(range(0, len(l) + 1)) as i from names) q""",
    "release_dates": """select strftime(d, '%Y%m%d') as release, concat(' [ClinVar build: ', strftime(d, '%m-%d-%Y'), ']') as stamp, count(*) as n
from (select cast(o_orderdate as date) as d from orders) q group by d""",
    "natural_names": """select concat('s10.shard_', c_custkey, '.vcf') as name, row_number() over (order by c_custkey) as place from customer""",
    "concat_places": f"""with {ORDER_SITES}
select contig, pos, alleles, row_number() over (order by {RANK}, contig, pos, string_split(alleles, ',')) as place from (
  select contig, pos, concat(ref, ',', alt) as alleles from fx_alts union all select contig, pos, alleles from second) q""",
    "genome_shards": f"""select contig, pos, concat(ref, ',', alt) as alleles,
  cast((row_number() over (order by {RANK}, contig, pos, [ref, alt]) - 1) // 700 as int) as shard from fx_alts""",
    "file_chunks": """select s_suppkey as idx, s_name as path,
  lpad(cast((row_number() over (order by s_suppkey) - 1) // 7 as varchar), 4, '0') as chunk from supplier""",
    "one_contig": "select contig, pos, concat(ref, ',', alt) as alleles from fx_alts where contig = 'chr7'",
    "other_build": "select contig, pos, concat(ref, ',', alt) as alleles, false as has_clnsig from fx_alts",
    "union_by_place": """select contig, pos, mpc as score from fx_score union all select contig, pos, raw_score from fx_cadd""",
    "split_depths": _ORACLES["ad_collapse"],
    "text_qualities": f"""with {CELLS}
select contig, pos, alleles, cast(smp as int) as smp, cast(pk % 100 as int) as gq, case when pk % 10 <> 7 then
  array_to_string(list_transform(range(0, (n + 1) * (n + 2) // 2), lambda j: (pk + 17 * j) % 99), ',') end as pl from cells""",
    "merge_repeats": """with a as (select cast(o_orderkey % 500 as int) as pos, count(*) as n, sum(o_orderkey % 40) as depth,
    sum(o_orderkey % 5) as ac, sum(o_orderkey % 9) as dp, max(o_orderkey % 50) as qual from orders group by 1),
b as (select cast(o_custkey % 700 as int) as pos, count(*) as n, sum(o_custkey % 40) as depth,
    sum(o_custkey % 5) as ac, sum(o_custkey % 9) as dp, max(o_custkey % 50) as qual from orders group by 1)
select 'chr1' as contig, pos, greatest(coalesce(a.n, 0), coalesce(b.n, 0)) as records, cast(a.depth as bigint) as depth_a,
  cast(b.depth as bigint) as depth_b, coalesce(a.n, 0) as n_a, coalesce(b.n, 0) as n_b,
  cast(coalesce(a.ac, 0) + coalesce(b.ac, 0) as bigint) as ac, cast(coalesce(a.dp, 0) + coalesce(b.dp, 0) as bigint) as dp,
  cast(greatest(coalesce(a.qual, 0), coalesce(b.qual, 0)) as double) as qual, cast(coalesce(a.n, 0) as bigint) as from_a,
  cast(coalesce(a.n, 0) + coalesce(b.n, 0) as bigint) as ids from a full join b using (pos)""",
    "attach_repeats": """with a as (select cast(o_orderkey % 500 as int) as pos, count(*) as n, count(distinct o_orderkey % 50) as quals
  from orders group by 1), b as (select cast(o_custkey % 700 as int) as pos, count(*) as n, min(o_custkey % 40) as least,
  max(o_custkey % 40) as most, count(distinct o_custkey % 40) as depths from orders group by 1)
select 'chr1' as contig, pos, greatest(a.n, b.n) as records, cast(least as int) as least, cast(most as int) as most, depths, quals
from a join b using (pos)""",
    "interval_annotate_merge": _ORACLES["interval_annotate"],
    "lookup_many_merge": _ORACLES["lookup_many"],
    "annotate_extra_dev_merge": _ORACLES["annotate_extra_dev"],
}

MORE_ORACLES = {name: with_inputs(sql) for name, sql in _MORE.items()}
