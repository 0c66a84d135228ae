"""DuckDB SQL with the expected result of each registered query, written on long tables."""

from suite.inputs import _contig, with_inputs

VARIANT = "v.contig, v.pos, concat(v.ref, ',', v.alt) as alleles"
KEY = "contig, pos, ref, alt"


def _on(a: str, b: str) -> str:
    return " and ".join(f"{a}.{c} = {b}.{c}" for c in ("contig", "pos", "ref", "alt"))


def _first(table: str, values: str, order: str, keys: str = KEY) -> str:
    """One row per key: the first by the given order."""
    return f"""(select {keys}, {values} from (
  select *, row_number() over (partition by {keys} order by {order}) as rn from {table}) q where rn = 1)"""


# the split of every site: trimmed when there are several alternates
SPLIT = """
cut as (select *, left(ref, length(ref) - sfx) as r, left(alt, length(alt) - sfx) as a
  from (select *, case when n_alt = 1 then 0 else coalesce(list_max(list_filter(
          range(1, least(length(ref), length(alt))), lambda i: right(ref, i) = right(alt, i))), 0) end as sfx
        from fx_alts where n_alt = 1 or alt <> '*') q),
split as (select contig, pos as pos0, pos + pfx as pos, substr(r, pfx + 1) as ref, substr(a, pfx + 1) as alt, k, n_alt
  from (select *, case when n_alt = 1 then 0 else coalesce(list_max(list_filter(
          range(1, least(length(r), length(a))), lambda i: left(r, i) = left(a, i))), 0) end as pfx from cut) q)"""

CADD = _first("fx_cadd", "raw_score, phred_score", "raw_score, phred_score")
SCORE = f"(select {KEY}, min(mpc) as mpc from fx_score group by {KEY})"
REVEL = """(select contig, pos, ref, alt, min(revel) as revel from (
  select concat('chr', chr_raw) as contig, try_cast(grch38_pos as int) as pos, ref, alt, revel from fx_revel) q
  group by contig, pos, ref, alt)"""
CLINVAR_ROWS = """(select case when contig_raw = 'MT' then 'chrM' else concat('chr', contig_raw) end as contig,
  pos, ref, alt, clnsig, clnrevstat, clnsigconf, geneinfo from fx_clinvar)"""


def _clinvar(fields: str) -> str:
    order = ", ".join(f"{f.strip()} nulls first" for f in fields.split(","))
    return _first(CLINVAR_ROWS + " c", fields, order)


# transcripts as parsed: a packed string with one token has no fields
PARSED = """
parsed as (select contig, pos, ref, alt, tx_idx, csq, csq like '%|%' as whole,
  case when csq like '%|%' then split_part(csq, '|', 1) end as allele,
  case when csq like '%|%' then split_part(csq, '|', 2) end as terms,
  case when csq like '%|%' then split_part(csq, '|', 3) end as symbol,
  case when csq like '%|%' then split_part(csq, '|', 4) end as feature,
  case when csq like '%|%' then split_part(csq, '|', 5) end as hgvsc,
  case when csq like '%|%' then split_part(csq, '|', 6) end as hgvsp
  from fx_csq)"""

LISTS = """
lists as (select symbol, string_agg(list_name, '&' order by list_order) as names
  from (select distinct symbol, list_order, list_name from fx_gene_lists) q group by symbol)"""


def _transcript(join: str, field: str, outputs: str, ctes: str = "") -> str:
    return f"""with {PARSED}{ctes}
select {VARIANT}, tx_idx, v.{field} as looked_up, {outputs}
from parsed v left join {join}"""


def _default(key: str, value: str) -> str:
    return f"case when {key} is null then '' else {value} end"


# genotype matrix in long form; n is the number of alternates
LETTER = "substr('ACGT', cast((o % 4 + {k}) % 4 + 1 as int), 1)"
CELLS = f"""
sites as (select o, {_contig('o')} as contig, cast((o % 200000000) * 10 + 1 as int) as pos,
  cast(o % 3 + 1 as int) as n from (select distinct o from fx_cells) q),
named as (select *, concat({LETTER.format(k=0)}, ',', {LETTER.format(k=1)},
    case when n > 1 then concat(',', {LETTER.format(k=2)}) else '' end,
    case when n > 2 then concat(',', {LETTER.format(k=3)}) else '' end) as alleles from sites),
places as (select *, unnest(range(1, (select max(l_linenumber) from lineitem) + 1)) as smp from named),
cells as materialized (select p.*, c.pk, c.sk, c.pk is not null and c.pk % 11 > 0 as called,
    c.pk % (p.n + 1) as a1, c.sk % (p.n + 1) as a2, p.contig = 'chrY' as haploid
  from places p left join fx_cells c on p.o = c.o and p.smp = c.smp)"""
CALL = """case when not called then './.' when haploid then cast(a1 as varchar)
  else concat(least(a1, a2), '/', greatest(a1, a2)) end"""
FIXED_CALL = CALL.replace("cast(a1 as varchar)", "concat(a1, '/', a1)")
ALLELES = """
calls as (select o, a1 as allele from cells where called
  union all select o, a2 as allele from cells where called and not haploid),
found as (select o, allele, count(*) as ac from calls group by o, allele),
counted as materialized (select s.o, s.contig, s.pos, s.alleles, s.n, s.k, coalesce(c.ac, 0) as ac
  from (select *, unnest(range(0, n + 1)) as k from named) s left join found c on s.o = c.o and s.k = c.allele)"""
PER_ALT = f"""
alt as materialized (select *, concat({LETTER.format(k=0)}, ',', {LETTER.format(k='k')}) as pair
  from (select *, unnest(range(1, n + 1)) as k from cells) q)"""
SPLIT_KEY = "contig, pos, pair as alleles, cast(k as int) as a_index, cast(smp as int) as smp"

ORDER_SITES = f"""
second as (select o_orderkey as o, {_contig('o_orderkey')} as contig,
  cast((o_orderkey % 200000000) * 10 + 1 as int) as pos, o_custkey as cust, o_orderpriority as priority,
  concat(substr('ACGT', cast((o_orderkey % 4) % 4 + 1 as int), 1), ',', substr('ACGT', cast((o_orderkey % 4 + 1) % 4 + 1 as int), 1),
    case when o_custkey % 3 > 0 then concat(',', substr('ACGT', cast((o_orderkey % 4 + 2) % 4 + 1 as int), 1)) else '' end,
    case when o_custkey % 3 > 1 then concat(',', substr('ACGT', cast((o_orderkey % 4 + 3) % 4 + 1 as int), 1)) else '' end) as alleles
  from orders)"""

RANK = """case substr(contig, 4) when 'X' then 23 when 'Y' then 24 else try_cast(substr(contig, 4) as int) end"""

ENRICH_DEV = f"""
with {PARSED}, {LISTS},
tx as (select p.*, concat_ws('|', coalesce(allele, ''), coalesce(terms, ''), coalesce(p.symbol, ''), coalesce(feature, ''),
    coalesce(hgvsc, ''), coalesce(hgvsp, '')) as head,
  coalesce({_default('l.transcript', 'oe_lof_upper')}, '') as v2, {_default('l.transcript', 'oe_lof_upper_bin')} as v2d,
  {_default('l.transcript', 'v4_upper')} as v4, {_default('l.transcript', 'v4_decile')} as v4d,
  {_default('g.gene', 'g.mim_number')} as mim, {_default('g.gene', 'g.inheritance_code')} as inh,
  {_default('g.gene', 'g.gencc_classification')} as gencc, coalesce(s.names, '') as lists,
  case when g.gene is null then '' else 'genes.txt' end as one_list
  from parsed p left join fx_loeuf l on p.feature = l.transcript
  left join fx_gene g on p.symbol = g.gene left join lists s on p.symbol = s.symbol)"""

SPLICE_RAW = "(select contig, pos, ref, alt, symbol, min(spliceai) as raw from fx_splice group by contig, pos, ref, alt, symbol)"
GATE = """(list_contains(string_split(v.terms, '&'), 'splice_donor_5th_base_variant')
  or list_contains(string_split(v.terms, '&'), 'splice_region_variant')
  or list_contains(string_split(v.terms, '&'), 'splice_donor_region_variant'))"""


def _splice_from(gated: bool, source: str = "parsed") -> str:
    gate = f" and {GATE}" if gated else ""
    return f"from {source} v left join {SPLICE_RAW} r on {_on('v', 'r')} and v.symbol = r.symbol{gate}"


SPLICE_NAMES = ["DS_AG", "DS_AL", "DS_DG", "DS_DL", "DP_AG", "DP_AL", "DP_DG", "DP_DL"]
SPLICE_CELLS = [
    f"case when r.raw is null then '' else split_part(r.raw, '|', {i + 3}) end" for i in range(8)
]
SPLICE_BEST = (
    "coalesce(cast(greatest("
    + ", ".join(f"try_cast(split_part(r.raw, '|', {i + 3}) as double)" for i in range(4))
    + ") as varchar), '')"
)


def _spliceai(gated: bool) -> str:
    cells = ", ".join(f"{c} as {n}" for c, n in zip(SPLICE_CELLS, SPLICE_NAMES))
    return f"""with {PARSED}
select {VARIANT}, tx_idx, {cells}, {SPLICE_BEST} as "spliceAI_score" {_splice_from(gated)}"""


BED_BEST = f"""(select contig, pos, ref, alt, target from (
  select a.contig, a.pos, a.ref, a.alt, d.target,
    row_number() over (partition by a.contig, a.pos, a.ref, a.alt order by d.start0, d.end0, d.target) as rn
  from fx_alts a join fx_bed d on a.contig = d.contig and a.pos > d.start0 and a.pos <= d.end0) q where rn = 1)"""

_ORACLES = {
    "split_multiallelic": f"""with {SPLIT}
select contig, cast(pos as int) as pos, concat(ref, ',', alt) as alleles, k as a_index, n_alt > 1 as was_split,
  n_alt + 1 as num_alleles from split""",
    "split_keep_sum": """select contig, pos, concat(ref, ',', alt) as alleles, k as a_index,
  cast(cast(pos as bigint) * k % 200 as varchar) as ac from fx_alts""",
    "contig_rename": """select case when contig_raw = 'MT' then 'chrM' else concat('chr', contig_raw) end as contig,
  pos, ref, alt, geneinfo from fx_clinvar""",
    "lookup_mpc": f"select {VARIANT}, m.mpc as \"MPC\" from fx_alts v left join {SCORE} m on {_on('v', 'm')}",
    "lookup_cadd": f"""select {VARIANT}, c.raw_score as "CADD_raw_score", c.phred_score as "CADD_PHRED_score"
from fx_alts v left join {CADD} c on {_on('v', 'c')}""",
    "cadd_vcf": f"""with {SPLIT}
select {VARIANT.replace('v.pos', 'cast(v.pos as int) as pos')}, v.k as a_index, c.raw_score as "CADD_raw_score",
  c.phred_score as "CADD_PHRED_score" from split v left join {CADD} c on {_on('v', 'c')}""",
    "lookup_revel": f"select {VARIANT}, r.revel as \"REVEL\" from fx_alts v left join {REVEL} r on {_on('v', 'r')}",
    "lookup_revel_hg19": """select v.contig, v.pos, concat(v.ref, ',', v.alt) as alleles, r.revel as "REVEL"
from (select substr(contig, 4) as contig, cast(pos + 7 as int) as pos, ref, alt from fx_alts) v
left join (select chr_raw, cast(hg19_pos as int) as pos, ref, alt, min(revel) as revel from fx_revel group by all) r
on v.contig = r.chr_raw and v.pos = r.pos and v.ref = r.ref and v.alt = r.alt""",
    "lookup_clinvar": f"""select {VARIANT}, c.clnsig as "CLNSIG", c.clnrevstat as "CLNREVSTAT"
from fx_alts v left join {_clinvar('clnsig, clnrevstat')} c on {_on('v', 'c')}""",
    "lookup_clinvar_fields": f"""select {VARIANT}, c.clnsig as "CLNSIG", c.clnrevstat as "CLNREVSTAT",
  c.clnsigconf as "CLNSIGCONF", c.geneinfo as "GENEINFO"
from fx_alts v left join {_clinvar('clnsig, clnrevstat, clnsigconf, geneinfo')} c on {_on('v', 'c')}""",
    "lookup_many": f"""select {VARIANT}, m.mpc as "MPC", c.clnsig as "CLNSIG", c.clnrevstat as "CLNREVSTAT", r.revel as "REVEL"
from fx_alts v left join {SCORE} m on {_on('v', 'm')}
left join {_clinvar('clnsig, clnrevstat')} c on {_on('v', 'c')} left join {REVEL} r on {_on('v', 'r')}""",
    "csq_parse": f"""with {PARSED}
select {VARIANT}, tx_idx, allele, case when whole then split_part(terms, '&', 1) end as first_term,
  case when whole then cast(length(terms) - length(replace(terms, '&', '')) + 1 as int) else 1 end as n_terms,
  symbol, feature, hgvsc, hgvsp from parsed v""",
    "csq_repack": f"""select {VARIANT}, c.csq from fx_alts v left join (
  select {KEY}, string_agg(case when csq like '%|%' then csq else '|||||' end, ',' order by tx_idx) as csq
  from fx_csq group by {KEY}) c on {_on('v', 'c')}""",
    "csq_regroup": f"""with {PARSED}
select {VARIANT}, c.features from fx_alts v left join (
  select {KEY}, string_agg(coalesce(feature, '-'), ',' order by tx_idx) as features from parsed group by {KEY}) c
on {_on('v', 'c')}""",
    "hgvsc_symbol": f"""with {PARSED}
select {VARIANT}, tx_idx, coalesce(concat_ws(':', symbol, case when hgvsc <> '' then split_part(hgvsc, ':', 2) end,
  case when hgvsp <> '' then split_part(hgvsp, ':', 2) end), '') as hgvsc_symbol from parsed v""",
    "lookup_loeuf": _transcript(
        "fx_loeuf l on v.feature = l.transcript",
        "feature",
        f"""{_default('l.transcript', 'oe_lof_upper')} as "LOEUF_v2",
  {_default('l.transcript', 'oe_lof_upper_bin')} as "LOEUF_v2_decile" """,
    ),
    "lookup_loeuf_v4": _transcript(
        "fx_loeuf l on v.feature = l.transcript",
        "feature",
        f"""{_default('l.transcript', 'v4_upper')} as "LOEUF_v4", {_default('l.transcript', 'v4_decile')} as "LOEUF_v4_decile" """,
    ),
    "lookup_omim": _transcript(
        "fx_gene g on v.symbol = g.gene",
        "symbol",
        f"""{_default('g.gene', 'mim_number')} as "OMIM_MIM_number",
  {_default('g.gene', 'inheritance_code')} as "OMIM_inheritance_code" """,
    ),
    "lookup_inheritance": _transcript(
        "fx_gene g on v.symbol = g.gene",
        "symbol",
        f"""{_default('g.gene', 'inheritance_code')} as inheritance_code,
  {_default('g.gene', 'gencc_classification')} as "genCC_classification" """,
    ),
    "gene_list_one": _transcript(
        "fx_gene g on v.symbol = g.gene", "symbol", "case when g.gene is null then '' else 'genes.txt' end as gene_list"
    ),
    "gene_list_many": _transcript(
        "lists s on v.symbol = s.symbol", "symbol", "coalesce(s.names, '') as gene_list", f", {LISTS}"
    ),
    "spliceai_gated": _spliceai(True),
    "spliceai_ungated": _spliceai(False),
    "interval_annotate": f"""select {VARIANT}, d.target as "PREDICTED_NONCODING"
from fx_alts v left join {BED_BEST} d on {_on('v', 'd')}""",
    "interval_annotate_matched": f"""select {VARIANT}, d.target as "PREDICTED_NONCODING"
from fx_alts v join {BED_BEST} d on {_on('v', 'd')}""",
    "interval_filter": f"""select {VARIANT} from fx_alts v where exists (
  select 1 from fx_bed d where v.contig = d.contig and v.pos > d.start0 and v.pos <= d.end0)""",
    "region_overlap": f"""select {VARIANT} from fx_alts v where exists (
  select 1 from fx_bed d where d.start0 < d.end0 and v.contig = d.contig and v.pos <= d.end0
  and v.pos + length(v.ref) - 1 > d.start0)""",
    "gt_downcode": f"""with {CELLS}, {PER_ALT}
select {SPLIT_KEY}, case when not called then './.' when haploid then cast(cast(a1 = k as int) as varchar)
  else concat(least(cast(a1 = k as int), cast(a2 = k as int)), '/', greatest(cast(a1 = k as int), cast(a2 = k as int))) end as gt
from alt""",
    "ad_collapse": f"""with {CELLS}, {PER_ALT}
select {SPLIT_KEY}, case when pk % 10 <> 3 then concat(
  list_sum([(pk + 3 * i) % 30 for i in range(0, n + 1)]) - (pk + 3 * k) % 30, ',', (pk + 3 * k) % 30) end as ad from alt""",
    "pl_collapse": f"""with {CELLS}, {PER_ALT},
lists as (select *, list_transform(range(0, 3), lambda copies: list_min(flatten(list_transform(range(0, n + 1), lambda g2:
    list_transform(list_filter(range(0, g2 + 1), lambda g1: cast(g1 = k as int) + cast(g2 = k as int) = copies),
                   lambda g1: (pk + 17 * (g2 * (g2 + 1) // 2 + g1)) % 99))))) as pls from alt)
select {SPLIT_KEY}, case when pk % 10 <> 7 then array_to_string(pls, ',') end as pl from lists""",
    "haploid_fix": f"with {CELLS} select contig, pos, alleles, cast(smp as int) as smp, {FIXED_CALL} as gt from cells",
    "call_stats": f"""with {CELLS}, {ALLELES}
select contig, pos, alleles, string_agg(cast(ac as varchar), ',' order by k) as ac, cast(sum(ac) as int) as "AN",
  case when sum(ac) > 0 then cast(sum(case when k = 1 then ac end) as double) / sum(ac) end as af1
from counted group by contig, pos, alleles""",
    "recount_cohort": f"""with {CELLS}, {ALLELES}
select contig, pos, concat({LETTER.format(k=0)}, ',', {LETTER.format(k='k')}) as alleles, cast(k as int) as a_index,
  cast(ac as int) as "cohort_AC", case when total > 0 then cast(ac as double) / total end as "cohort_AF"
from (select *, sum(ac) over (partition by o) as total from counted) q where k > 0""",
    "cohort_ac_af": f"""with {SPLIT}
select {VARIANT.replace('v.pos', 'cast(v.pos as int) as pos')}, k as a_index, cast(cast(pos0 as bigint) * k % 200 as int) as "cohort_AC",
  cast(cast(pos0 as bigint) * k % 200 as double) / 400 as "cohort_AF" from split v""",
    "as_fallback": f"""with {SPLIT},
f as (select *, case when pos0 % 3 > 0 then cast(pos0 % 100 as double) end as vq,
    case when pos0 % 9 > 0 then cast((pos0 + k) % 100 as double) end as as_vq,
    case when pos0 % 2 > 0 then cast(pos0 % 50 as double) end as sor,
    case when pos0 % 5 > 2 then cast((pos0 + k) % 50 as double) end as as_sor from split),
m as (select count(*) - count(vq) > count(*) - count(as_vq) as swap_vq,
    count(*) - count(sor) > count(*) - count(as_sor) as swap_sor from f)
select {VARIANT.replace('v.pos', 'cast(v.pos as int) as pos')}, k as a_index, case when swap_vq then as_vq else vq end as "VQSLOD",
  case when swap_sor then as_sor else sor end as "SOR" from f v, m""",
    "major_minor": f"""with {CELLS}, {ALLELES},
ranked as (select o, k, sum(ac) over (partition by o) as total,
    row_number() over (partition by o order by ac desc, k) as place from counted),
pair as (select o, max(total) as total, concat(max(case when place = 1 then k end), '/', max(case when place = 2 then k end)) as gt
  from ranked group by o)
select contig, pos, alleles, cast(smp as int) as smp, case when total > 0 then gt else './.' end as gt from cells join pair using (o)""",
    "subset_samples": f"""with {CELLS},
kept as (select *, concat('s', smp) as s from cells where smp in (select r_regionkey from region)),
carried as (select distinct o from kept where called and (a1 = 1 or (not haploid and a2 = 1)))
select contig, pos, alleles, s, {FIXED_CALL} as gt from kept join carried using (o)""",
    "drop_first_sample": f"""with {CELLS}
select contig, pos, alleles, concat('s', smp) as s, cast(sk % 60 as int) as dp from cells where smp > 1""",
    "attach_genotypes": f"""with {CELLS}, {ORDER_SITES}
select c.contig, c.pos, c.alleles, s.priority, cast(c.smp as int) as smp, cast(c.sk % 60 as int) as dp
from cells c join second s on c.contig = s.contig and c.pos = s.pos and c.alleles = s.alleles""",
    "merge_samples": f"""with {CELLS}, {ORDER_SITES},
every as (select contig, pos, alleles from named union select contig, pos, alleles from second),
first_file as (select e.*, p.s, coalesce(c.gt, './.') as gt, c.dp
  from (select *, unnest(range(1, (select max(l_linenumber) from lineitem) + 1)) as smp from every) e
  join (select unnest(range(1, (select max(l_linenumber) from lineitem) + 1)) as smp, concat('s', smp) as s) p using (smp)
  left join (select contig, pos, alleles, smp, {CALL} as gt, cast(sk % 60 as int) as dp from cells) c
    using (contig, pos, alleles, smp)),
second_file as (select e.contig, e.pos, e.alleles, '2:s1' as s,
  case when s.cust is null then './.' else concat(s.cust % 2, '/1') end as gt, cast(s.cust % 40 as int) as dp
  from every e left join second s using (contig, pos, alleles))
select contig, pos, alleles, s, gt, dp from first_file union all select * from second_file""",
    "strip_format": f"""with {CELLS}
select contig, pos, alleles, cast(smp as int) as smp, 'GT,AD,DP,GQ,PL' as fields, cast(sk % 60 as int) as dp,
  cast(pk % 100 as int) as gq from cells""",
    "sample_chunk_pairs": """with c as (select c_name as s, (row_number() over (order by c_name) - 1) // 500 as chunk from customer),
ids as (select distinct chunk from c),
pairs as (select a.chunk as a, b.chunk as b from ids a join ids b on a.chunk < b.chunk
  union all select chunk, null from ids where (select count(*) from ids) = 1),
numbered as (select *, row_number() over (order by a, b) - 1 as shard from pairs)
select cast(shard as int) as shard, cast(a as int) as chunk_a, cast(b as int) as chunk_b, s
from numbered join c on c.chunk = a or c.chunk = b""",
    "family_chunks": """with f as (select family_id, (row_number() over (order by min(row_idx)) - 1) // 100 as chunk
  from fx_ped group by family_id)
select cast(chunk as int) as chunk, family_id, sample_id from fx_ped join f using (family_id)""",
    "union_outer": """select contig, pos, alt, mpc, cast(null as double) as raw_score from fx_score
union all select contig, pos, alt, null, raw_score from fx_cadd""",
    "union_rows": "select contig, pos, mpc as score from fx_score union all select contig, pos, raw_score from fx_cadd",
    "union_by_position": "select contig, pos, mpc as score from fx_score union all select contig, pos, raw_score from fx_cadd",
    "concat_sorted": f"""with {ORDER_SITES}
select contig, pos, concat(ref, ',', alt) as alleles from fx_alts union all select contig, pos, alleles from second""",
    "genome_order": f"""select {VARIANT}, row_number() over (order by {RANK}, pos, ref, alt) as row_number from fx_alts v""",
    "contig_counts": "select contig, count(*) as n from fx_alts group by contig",
    "shard_plan": "select contig, count(*) as n, cast((count(*) + 999) // 1000 as int) as n_shards from fx_alts group by contig",
    "chunk_rows": "select c_custkey, c_name, cast((row_number() over (order by c_custkey) - 1) // 400 as int) as chunk from customer",
    "contig_shards": f"""select {VARIANT},
  cast((row_number() over (partition by contig order by pos, ref, alt) - 1) // 500 as int) as shard from fx_alts v""",
    "vcf_text_sites": """with s as (select contig, pos, ref, string_agg(alt, ',' order by alt) as alts, count(alt) as n
  from (select distinct contig, pos, ref, alt from fx_obs) q group by contig, pos, ref)
select contig, pos, case when n > 0 then concat(ref, ',', alts) else ref end as alleles,
  case when n > 0 then array_to_string([cast(pos as bigint) * i % 200 for i in range(1, n + 1)], ',') end as ac,
  case when n > 0 then cast(pos % 200 as double) / 400 end as af,
  case when pos % 3 > 0 then cast(pos % 100 as double) end as "VQSLOD",
  case when pos % 2 > 0 then cast(pos % 50 as double) end as "SOR" from s""",
    "vcf_text_genotypes": f"""with {CELLS}
select contig, pos, alleles, cast(smp as int) as smp, {CALL} as gt,
  case when pk % 10 <> 3 then array_to_string([(pk + 3 * i) % 30 for i in range(0, n + 1)], ',') end as ad,
  cast(sk % 60 as int) as dp from cells""",
    "annotate_vcf": f"""with {SPLIT}
select {VARIANT.replace('v.pos', 'cast(v.pos as int) as pos')}, v.k as a_index, cast(cast(pos0 as bigint) * k % 200 as int) as "cohort_AC",
  case when pos0 % 9 > 0 then cast((pos0 + k) % 100 as double) end as "VQSLOD", c.csq
from split v left join (select {KEY}, string_agg(csq, ',' order by tx_idx) as csq from fx_csq group by {KEY}) c
on {_on('v', 'c')}""",
    "annotate_inheritance": f"""{ENRICH_DEV}
select {VARIANT}, c.csq from fx_alts v left join (
  select {KEY}, string_agg(concat_ws('|', head, inh, gencc, lists), ',' order by tx_idx) as csq from tx group by {KEY}) c
on {_on('v', 'c')}""",
    "annotate_hgvs": f"""with {PARSED}
select {VARIANT}, c.csq from fx_alts v left join (
  select {KEY}, string_agg(concat(case when whole then csq else '|||||' end, '|',
    coalesce(concat_ws(':', symbol, case when hgvsc <> '' then split_part(hgvsc, ':', 2) end,
      case when hgvsp <> '' then split_part(hgvsp, ':', 2) end), '')), ',' order by tx_idx) as csq
  from parsed group by {KEY}) c on {_on('v', 'c')}""",
    "annotate_extra": f"""{ENRICH_DEV},
full_tx as (select v.*, concat_ws('|', head, v2, v2d, v4, v4d, mim, inh, one_list, {', '.join(SPLICE_CELLS)}) as text
  {_splice_from(False, 'tx')})
select {VARIANT}, m.mpc as "MPC", c.clnsig as "CLNSIG", c.clnrevstat as "CLNREVSTAT", r.revel as "REVEL", t.csq
from fx_alts v left join {SCORE} m on {_on('v', 'm')}
left join {_clinvar('clnsig, clnrevstat')} c on {_on('v', 'c')} left join {REVEL} r on {_on('v', 'r')}
left join (select {KEY}, string_agg(text, ',' order by tx_idx) as csq from full_tx group by {KEY}) t on {_on('v', 't')}""",
    "annotate_extra_dev": f"""{ENRICH_DEV},
full_tx as (select v.*, concat_ws('|', head, v2, v2d, v4, v4d, inh, gencc, lists, {', '.join(SPLICE_CELLS)}, {SPLICE_BEST}) as text
  {_splice_from(True, 'tx')})
select {VARIANT}, d.target as "PREDICTED_NONCODING", m.mpc as "MPC", c.clnsig as "CLNSIG", c.clnrevstat as "CLNREVSTAT",
  c.clnsigconf as "CLNSIGCONF", r.revel as "REVEL", t.csq
from fx_alts v left join {SCORE} m on {_on('v', 'm')}
left join {_clinvar('clnsig, clnrevstat, clnsigconf')} c on {_on('v', 'c')} left join {REVEL} r on {_on('v', 'r')}
left join {BED_BEST} d on {_on('v', 'd')}
left join (select {KEY}, string_agg(text, ',' order by tx_idx) as csq from full_tx group by {KEY}) t on {_on('v', 't')}""",
    "annotate_table": f"""{ENRICH_DEV}
select {VARIANT}, m.mpc as "MPC", c.clnsig as "CLNSIG", r.revel as "REVEL", t.tx_idx, t.feature,
  {_default('l.transcript', 'l.oe_lof_upper')} as loeuf_v2, t.mim as omim, t.one_list as gene_list
from fx_alts v join tx t on {_on('v', 't')} left join fx_loeuf l on t.feature = l.transcript
left join {SCORE} m on {_on('v', 'm')}
left join {_clinvar('clnsig, clnrevstat')} c on {_on('v', 'c')} left join {REVEL} r on {_on('v', 'r')}""",
    "annotate_matrix": f"""with {SPLIT}
select {VARIANT.replace('v.pos', 'cast(v.pos as int) as pos')}, v.k as a_index, cast(cast(pos0 as bigint) * k % 200 as int) as "cohort_AC",
  'old' as original, c.csq
from split v left join (select {KEY}, string_agg(csq, ',' order by tx_idx) as csq from fx_csq group by {KEY}) c
on {_on('v', 'c')}""",
    "annotate_family": f"""with {CELLS}, {PER_ALT}
select contig, pos, pair as alleles, concat('s', smp) as s, cast(cast(pos as bigint) * k % 200 as int) as ac,
  case when k = 1 then concat(split_part(pair, ',', 2), '|stop_gained|G|T|T:c.', pos, '||G:c.', pos) end as csq,
  case when not called then './.' when haploid then cast(cast(a1 = k as int) as varchar)
    else concat(least(cast(a1 = k as int), cast(a2 = k as int)), '/', greatest(cast(a1 = k as int), cast(a2 = k as int))) end as gt
from alt where smp > 1""",
    "annotate_somatic": f"""with {CELLS}, {PER_ALT},
ones as (select o, k, cast(coalesce(sum(case when called then cast(a1 = k as int) + case when haploid then 0 else cast(a2 = k as int) end end), 0) as int) as hits,
    cast(coalesce(sum(case when called then case when haploid then 1 else 2 end end), 0) as int) as total
  from alt group by o, k)
select contig, pos, pair as alleles, cast(smp as int) as smp, cast(cast(pos as bigint) * k % 200 as int) as ac,
  case when k = 1 then concat(split_part(pair, ',', 2), '|stop_gained|G|T|T:c.', pos, '||G:c.', pos) end as csq,
  case when total = 0 then './.' else '0/1' end as gt
from alt join ones using (o, k)""",
}

ORACLES = {name: with_inputs(sql) for name, sql in _ORACLES.items()}
