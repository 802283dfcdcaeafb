"""DuckDB SQL for the registered queries, written from the rules."""

from __future__ import annotations

from checks.fixtures import RAW_BOOKINGS_SQL, RAW_SLOTS_SQL

_BOOLEAN = "('f','F','FAUX','FALSE','false','t','T','VRAI','TRUE','true')"

# Department, region code, region short name, by the official list.
_DIMENSION = """
dim as (
  select * from (values
    ('971', '01', 'GDP'), ('972', '02', 'MAR'), ('973', '03', 'GUY'), ('974', '04', 'REU'),
    ('976', '06', 'MAY'), ('75', '11', 'IDF'), ('77', '11', 'IDF'), ('78', '11', 'IDF'),
    ('91', '11', 'IDF'), ('92', '11', 'IDF'), ('93', '11', 'IDF'), ('94', '11', 'IDF'),
    ('95', '11', 'IDF'), ('18', '24', 'CVL'), ('28', '24', 'CVL'), ('36', '24', 'CVL'),
    ('37', '24', 'CVL'), ('41', '24', 'CVL'), ('45', '24', 'CVL'), ('21', '27', 'BFC'),
    ('25', '27', 'BFC'), ('39', '27', 'BFC'), ('58', '27', 'BFC'), ('70', '27', 'BFC'),
    ('71', '27', 'BFC'), ('89', '27', 'BFC'), ('90', '27', 'BFC'), ('14', '28', 'NOR'),
    ('27', '28', 'NOR'), ('50', '28', 'NOR'), ('61', '28', 'NOR'), ('76', '28', 'NOR'),
    ('02', '32', 'HDF'), ('59', '32', 'HDF'), ('60', '32', 'HDF'), ('62', '32', 'HDF'),
    ('80', '32', 'HDF'), ('08', '44', 'GES'), ('10', '44', 'GES'), ('51', '44', 'GES'),
    ('52', '44', 'GES'), ('54', '44', 'GES'), ('55', '44', 'GES'), ('57', '44', 'GES'),
    ('67', '44', 'GES'), ('68', '44', 'GES'), ('88', '44', 'GES'), ('44', '52', 'PDL'),
    ('49', '52', 'PDL'), ('53', '52', 'PDL'), ('72', '52', 'PDL'), ('85', '52', 'PDL'),
    ('22', '53', 'BRE'), ('29', '53', 'BRE'), ('35', '53', 'BRE'), ('56', '53', 'BRE'),
    ('16', '75', 'NAQ'), ('17', '75', 'NAQ'), ('19', '75', 'NAQ'), ('23', '75', 'NAQ'),
    ('24', '75', 'NAQ'), ('33', '75', 'NAQ'), ('40', '75', 'NAQ'), ('47', '75', 'NAQ'),
    ('64', '75', 'NAQ'), ('79', '75', 'NAQ'), ('86', '75', 'NAQ'), ('87', '75', 'NAQ'),
    ('09', '76', 'OCC'), ('11', '76', 'OCC'), ('12', '76', 'OCC'), ('30', '76', 'OCC'),
    ('31', '76', 'OCC'), ('32', '76', 'OCC'), ('34', '76', 'OCC'), ('46', '76', 'OCC'),
    ('48', '76', 'OCC'), ('65', '76', 'OCC'), ('66', '76', 'OCC'), ('81', '76', 'OCC'),
    ('82', '76', 'OCC'), ('01', '84', 'ARA'), ('03', '84', 'ARA'), ('07', '84', 'ARA'),
    ('15', '84', 'ARA'), ('26', '84', 'ARA'), ('38', '84', 'ARA'), ('42', '84', 'ARA'),
    ('43', '84', 'ARA'), ('63', '84', 'ARA'), ('69', '84', 'ARA'), ('73', '84', 'ARA'),
    ('74', '84', 'ARA'), ('04', '93', 'PAC'), ('05', '93', 'PAC'), ('06', '93', 'PAC'),
    ('13', '93', 'PAC'), ('83', '93', 'PAC'), ('84', '93', 'PAC'), ('2A', '94', 'COR'),
    ('2B', '94', 'COR')
  ) as t(dep, reg, nom)
)"""

# Raw rows, their parsed dates and their reject reason.
_TAGGED = f"""
raw as ({RAW_BOOKINGS_SQL}),
parsed as (
  select * replace (
      case when operateur = 'maiia' then 'NR' else type_vaccin end as type_vaccin,
      case when operateur = 'doctolib' then 'NR' else annee_naissance end as annee_naissance),
    cast(case when operateur = 'keldoc' then try_strptime(date_rdv, '%d/%m/%y')
         else try_strptime(date_rdv, '%Y-%m-%d') end as date) as jour,
    cast(case when operateur = 'keldoc' then try_strptime(date_creation, '%d/%m/%y')
         else try_strptime(date_creation, '%Y-%m-%d') end as date) as jour_creation
  from raw
),
tagged as (
  select *,
    case
      when honore is not null and honore not in {_BOOLEAN} then 'honore'
      when annule is not null and annule not in {_BOOLEAN} then 'annule'
      when jour is null then 'date_rdv'
      when date_creation is not null and jour_creation is null then 'date_creation'
      when cp_centre is null or not regexp_full_match(cp_centre, '[0-9]{{4,5}}( Cedex)?') then 'cp_centre'
    end as motif_rejet
  from parsed
),
valides as (select * from tagged where motif_rejet is null)"""


def _department(cp: str) -> str:
    number = f"try_cast(split_part({cp}, ' ', 1) as int)"
    return f"""case when {number} >= 20000 and {number} < 20200 then '2A'
      when {number} >= 20200 and {number} <= 20999 then '2B'
      when {cp} like '97%' then substr({cp}, 1, 3) else substr({cp}, 1, 2) end"""


def _flag(column: str) -> str:
    return f"""case when {column} is null then 'NR'
      when {column} in ('t','T','VRAI','TRUE','true') then 'true'
      when {column} in ('f','F','FAUX','FALSE','false') then 'false' end"""


_DOSE = """case when rang_vaccinal = 'R' or rang_vaccinal like '%3%' then '3'
      when rang_vaccinal like '%4%' then '4'
      when rang_vaccinal in ('1','2','5','6') then rang_vaccinal else 'NR' end"""
_VACCINE = """case when lower(motif_rdv) like '%pedia%' or lower(motif_rdv) like '%pédia%' then 'Pfizer Pédiatrique'
      when lower(motif_rdv) like '%pfizer%' then 'Pfizer'
      when lower(motif_rdv) like '%moderna%' then 'Moderna'
      when lower(motif_rdv) like '%janssen%' then 'Janssen'
      when lower(motif_rdv) like '%astrazeneca%' then 'AstraZeneca'
      else coalesce(type_vaccin, 'NR') end"""
_CNAM = "case when upper(motif_rdv) like '%CNAM%' then 'true' else 'false' end"
_BOOSTER = """case when upper(motif_rdv) like '%RAPPEL%' or motif_rdv like '%3%'
      or upper(motif_rdv) like '%IMMUN%' or upper(motif_rdv) like '%TROIS%' then 'true' else 'false' end"""
_PADDED = """case when length(cp_centre) = 4 and cp_centre not like '0%'
      then '0' || cp_centre else cp_centre end"""

_COLUMNS = """date_creation, date_rdv, id_centre, nom_centre, cp_centre, code_departement, code_region,
  region, motif_rdv, rang_vaccinal, parcours_rdv, annee_naissance, honore, annule, operateur,
  type_vaccin, rdv_cnam, rdv_rappel"""

_NORMALIZED = f"""{_TAGGED},{_DIMENSION},
cps as (select *, {_PADDED} as cp from valides),
deps as (select *, {_department("cp")} as dep_cp from cps),
norm as (
  select rdv_id, coalesce(jour_creation, jour) as date_creation, jour as date_rdv,
    coalesce(id_centre, 'NR') as id_centre, nom_centre, cp as cp_centre,
    dep_cp as code_departement, dim.reg as code_region, dim.nom as region,
    coalesce(motif_rdv, 'NR') as motif_rdv,
    {_DOSE} as rang_vaccinal,
    case when operateur = 'doctolib' then coalesce(parcours_rdv, 'NR') else parcours_rdv end as parcours_rdv,
    coalesce(annee_naissance, 'NR') as annee_naissance,
    {_flag("honore")} as honore,
    {_flag("annule")} as annule,
    operateur,
    {_VACCINE} as type_vaccin,
    {_CNAM} as rdv_cnam,
    {_BOOSTER} as rdv_rappel
  from deps left join dim on dim.dep = dep_cp
)"""

_PUBLISHABLE = f"""{_NORMALIZED},
effectifs as (select * from norm where honore <> 'false' and annule <> 'true'),
complets as (select * from effectifs where nom_centre is not null and region is not null),
fenetre as (
  select *, code_departement as departement,
    cast(date_trunc('week', date_rdv) as date) as date_debut_semaine
  from complets
  where date_rdv between date '2021-01-18' and date '2022-01-16' and rang_vaccinal <> 'NR'
)"""

_MEASURES = """count(*) as nb,
  count(*) filter (where rdv_cnam = 'true') as nb_rdv_cnam,
  count(*) filter (where rdv_rappel = 'true') as nb_rdv_rappel"""

_CONTROL = f"""{_NORMALIZED},
controle as (
  select id_centre, cp_centre, cast(weekofyear(date_rdv) as bigint) as num_semaine,
    cast(date_trunc('week', date_rdv) as date) as debut_semaine,
    count(*) filter (where annule = 'true') as rdv_annul,
    count(*) filter (where honore = 'true') as rdv_honore,
    count(*) filter (where annule = 'false' and honore = 'false') as rdv_non_honore
  from norm group by all
)"""

_RG2 = "debut_semaine < date '2021-12-13' and rdv_non_honore > rdv_honore"

_SLOTS = f"""
raw as ({RAW_SLOTS_SQL}),
filled as (
  select * replace (
      case when operateur = 'maiia' then 'NR' else nb_creneaux end as nb_creneaux,
      case when operateur = 'maiia' then 'NR' else type_vaccin end as type_vaccin),
    split_part(date_brute, ' ', 1) as jour
  from raw
),
cps as (
  select *, case when cp_centre like '0%' then cp_centre
      when length(ltrim1) = 4 then '0' || ltrim1 else ltrim1 end as cp
  from (select *, case when cp_centre like ' %' then substr(cp_centre, 2) else cp_centre end as ltrim1 from filled) q
),
deps as (select *, {_department("cp")} as dep_cp from cps),{_DIMENSION},
slots as (
  select l_orderkey, l_linenumber,
    cast(case when operateur = 'keldoc'
      then coalesce(try_strptime(jour, '%m/%d/%Y'), try_strptime(jour, '%d/%m/%Y'))
      else try_strptime(jour, '%Y-%m-%d') end as date) as date,
    date_brute as date_texte,
    id_centre, nom_centre, cp as cp_centre, dep_cp as code_departement,
    dim.reg as code_region, dim.nom as region,
    case when operateur = 'keldoc' and nb_heures = ' -   ' then null else nb_heures end as nb_heures,
    case when operateur = 'keldoc' and nb_lignes = ' -   ' then null else nb_lignes end as nb_lignes,
    case when operateur = 'keldoc' and nb_creneaux = ' -   ' then null else nb_creneaux end as nb_creneaux,
    type_vaccin, operateur
  from deps left join dim on dim.dep = dep_cp
)"""

_RAW_COLUMNS = """date_creation, date_rdv, id_centre, nom_centre, cp_centre, motif_rdv, rang_vaccinal,
  parcours_rdv, annee_naissance, honore, annule, type_vaccin, operateur"""
_SLOT_COLUMNS = """date, date_texte, id_centre, nom_centre, cp_centre, code_departement, code_region, region,
  nb_heures, nb_lignes, nb_creneaux, type_vaccin, operateur"""

_CENTRE_DAY = f"""with {_PUBLISHABLE}
select date_rdv, id_centre, nom_centre, cp_centre, code_departement, code_region, region,
  rang_vaccinal, operateur, type_vaccin, {_MEASURES}
from complets group by all"""



def _ars(where: str = "") -> str:
    return f"""with {_PUBLISHABLE}
select code_region, region, code_departement as departement, id_centre, nom_centre,
  rang_vaccinal, type_vaccin, date_rdv, {_MEASURES}
from complets {where} group by all"""


_PUBLISHED = f"""with {_PUBLISHABLE}
select code_region, region, departement, id_centre, nom_centre, rang_vaccinal, date_debut_semaine,
  {_MEASURES}, 'centre' as niveau from fenetre
  group by code_region, region, departement, id_centre, nom_centre, rang_vaccinal, date_debut_semaine
union all
select code_region, region, departement, null, null, rang_vaccinal, date_debut_semaine,
  count(*), null, null, 'departement' from fenetre
  group by code_region, region, departement, rang_vaccinal, date_debut_semaine
union all
select code_region, region, null, null, null, rang_vaccinal, date_debut_semaine,
  count(*), null, null, 'region' from fenetre
  group by code_region, region, rang_vaccinal, date_debut_semaine
union all
select null, null, null, null, null, rang_vaccinal, date_debut_semaine,
  count(*), null, null, 'national' from fenetre
  group by rang_vaccinal, date_debut_semaine"""

_SUMMARY = f"""with {_CONTROL},
regles as (select *, rdv_annul > rdv_honore as r1, {_RG2} as r2 from controle)
select count(*) filter (where r1) as rg1_groupes,
  count(distinct case when r1 then cp_centre end) as rg1_codes_postaux,
  count(distinct case when r1 then id_centre end) as rg1_centres,
  count(*) filter (where r2) as rg2_groupes,
  count(distinct case when r2 then cp_centre end) as rg2_codes_postaux,
  count(distinct case when r2 then id_centre end) as rg2_centres
from regles"""

_BOOKINGS = f"with {_NORMALIZED} select {_COLUMNS} from norm"


def _snapshot(names: str) -> str:
    return f"""with noms as ({names}),
possibles as (select * from noms where date_depot <= date '1998-06-15')
select operateur, max(date_depot) as date_depot, arg_max(depot, date_depot) as depot
from possibles group by operateur"""


def _weekly(keys: str, measures: str) -> str:
    return f"with {_PUBLISHABLE} select {keys}, {measures} from fenetre group by all"


ORACLES = {
    # Validation
    "format_checks": f"""with {_TAGGED}
select rdv_id, honore is null or honore in {_BOOLEAN} as honore_valide,
  annule is null or annule in {_BOOLEAN} as annule_valide,
  jour is not null as date_rdv_valide,
  date_creation is null or jour_creation is not null as date_creation_valide,
  cp_centre is not null and regexp_full_match(cp_centre, '[0-9]{{4,5}}( Cedex)?') as cp_centre_valide
from tagged""",
    "reject_counts": f"""with {_TAGGED}
select operateur, motif_rejet, count(*) as nb_lignes from tagged
where motif_rejet is not null group by all""",
    "rejects": f"""with {_TAGGED}
select rdv_id, {_RAW_COLUMNS}, motif_rejet, date '2021-12-17' as date_traitement
from tagged where motif_rejet is not null""",
    "valid_rdv": f"with {_TAGGED} select rdv_id, {_RAW_COLUMNS} from valides",
    "threshold_alert": f"""with {_TAGGED}
select date '2021-12-17' as date_traitement, operateur, count(*) as tot_row,
  count(motif_rejet) as err_row, count(motif_rejet) / count(*) as taux_erreur,
  count(motif_rejet) / count(*) > 0.001 as alerte
from tagged group by operateur""",
    "quality_warnings": f"""with {_TAGGED}
select operateur, count(*) filter (where id_centre is null) as nb_id_centre_absent,
  count(*) filter (where annee_naissance is null) as nb_annee_naissance_absente,
  max(year(jour)) as annee_max, max(year(jour)) >= 2022 as rdv_2022_ou_apres,
  true as publie_un_vendredi
from valides group by operateur""",
    # Normalisation
    "normalized_rdv": f"with {_NORMALIZED} select rdv_id, {_COLUMNS} from norm",
    "dose_norm": f"with {_TAGGED} select rdv_id, rang_vaccinal as brut, {_DOSE} as rang from parsed",
    "vaccine_type": f"with {_TAGGED} select rdv_id, motif_rdv, {_VACCINE} as type_vaccin from parsed",
    "motif_flags": f"with {_TAGGED} select rdv_id, {_CNAM} as rdv_cnam, {_BOOSTER} as rdv_rappel from parsed",
    "bool_norm": f"""with {_TAGGED}
select rdv_id, {_flag("honore")} as honore, {_flag("annule")} as annule from valides""",
    "date_parse": f"""with {_TAGGED}
select rdv_id, jour as date_rdv, coalesce(jour_creation, jour) as date_creation from parsed""",
    "dep_from_cp": f"""with {_NORMALIZED}
select rdv_id, cp as cp_centre, dep_cp as code_departement from deps""",
    "region_lookup": f"""with {_NORMALIZED}
select rdv_id, cp_centre, code_departement, code_region, region from norm""",
    "week_keys": f"""with {_NORMALIZED}
select rdv_id, date_rdv, cast(weekofyear(date_rdv) as bigint) as num_semaine,
  cast(date_trunc('week', date_rdv) as date) as debut_semaine,
  date_rdv between date '2021-01-18' and date '2022-01-16' as dans_fenetre
from norm""",
    "effective_rdv": f"with {_PUBLISHABLE} select rdv_id, honore, annule from effectifs",
    # Rollups
    "centre_day": _CENTRE_DAY,
    "merge_rollup": _CENTRE_DAY,
    "ars_daily": _ars(),
    "region_extract_idf": _ars("where region = 'IDF'"),
    "weekly_centre": _weekly(
        "code_region, region, departement, id_centre, nom_centre, rang_vaccinal, date_debut_semaine",
        _MEASURES,
    ),
    "weekly_dep": _weekly(
        "code_region, region, departement, rang_vaccinal, date_debut_semaine", "count(*) as nb"
    ),
    "weekly_reg": _weekly("code_region, region, rang_vaccinal, date_debut_semaine", "count(*) as nb"),
    "weekly_national": _weekly("rang_vaccinal, date_debut_semaine", "count(*) as nb"),
    "weekly_hierarchy": f"""with {_PUBLISHABLE}
select 'departement' as niveau, code_region, region, departement, rang_vaccinal, date_debut_semaine,
  count(*) as nb from fenetre group by all
union all
select 'region', code_region, region, null, rang_vaccinal, date_debut_semaine, count(*)
  from fenetre group by code_region, region, rang_vaccinal, date_debut_semaine
union all
select 'national', null, null, null, rang_vaccinal, date_debut_semaine, count(*)
  from fenetre group by rang_vaccinal, date_debut_semaine""",
    "excluded_null_keys": f"""with {_PUBLISHABLE}
select count(*) as nb_effectifs,
  count(*) filter (where nom_centre is null or region is null) as nb_exclus_cle_nulle,
  count(*) filter (where region is null) as nb_region_inconnue,
  count(*) filter (where nom_centre is null) as nb_nom_centre_absent
from effectifs""",
    # Controls
    "control_table": f"with {_CONTROL} select * from controle",
    "rg1": f"with {_CONTROL} select * from controle where rdv_annul > rdv_honore",
    "rg2": f"with {_CONTROL} select * from controle where {_RG2}",
    "rg2_week_number": f"""with {_CONTROL}
select * from controle where num_semaine < 50 and rdv_non_honore > rdv_honore""",
    "rg_summary": _SUMMARY,
    # Slots
    "normalized_creneaux": f"with {_SLOTS} select * from slots",
    "creneaux_union": f"with {_SLOTS} select * from slots",
    "creneaux_keldoc_clean": f"""with {_SLOTS}
select l_orderkey, l_linenumber, date, date_texte, nb_heures, nb_lignes, nb_creneaux
from slots where operateur = 'keldoc'""",
    "creneaux_postcodes": f"""with {_SLOTS}
select l_orderkey, l_linenumber, cp_centre as cp_brut, cp as cp_centre, dep_cp as code_departement
from deps""",
    # Files
    "asof_snapshot": _snapshot("""
select case o_orderkey % 4 when 0 then 'maiia' when 1 then 'keldoc' else 'doctolib' end as operateur,
  cast(o_orderdate as date) as date_depot,
  'depots/' || case o_orderkey % 4
    when 0 then strftime(o_orderdate, '%Y-%m-%d') || '-maiia-rdv.csv'
    when 1 then strftime(o_orderdate, '%Y-%m-%d') || '-keldoc-rdv.csv'
    else strftime(o_orderdate, '%d-%m-%Y') || '_vaccination_appointments.csv' end as depot
from orders where o_orderkey % 4 <> 3"""),
    "asof_slot_snapshot": _snapshot("""
select operateur, date_depot,
  'depots/' || strftime(date_depot, '%Y-%m-%d') || '-' || operateur || '-plages-horaires.csv' as depot
from (select cast(l_shipdate as date) as date_depot,
    case l_linenumber % 3 when 0 then 'maiia' when 1 then 'keldoc' else 'doctolib' end as operateur
  from lineitem) q"""),
    "null_tokens": """
select rdv_id, brut, case when brut in ('NR', '-', 'NAN', 'n.a.') then brut end as valeur
from (select o_orderkey as rdv_id,
    case o_orderkey % 12 when 0 then 'NA' when 1 then 'null' when 2 then 'N/A' when 3 then 'nan'
      when 4 then 'None' when 5 then '' when 6 then 'NR' when 7 then '-' when 8 then 'NAN'
      when 9 then 'n.a.' when 10 then '#N/A' else 'NULL' end as brut
  from orders) q""",
    "scan_bookings": f"""with raw as ({RAW_BOOKINGS_SQL})
select {_RAW_COLUMNS} from (select * replace (
  case when operateur = 'doctolib' then 'NR' else annee_naissance end as annee_naissance) from raw) q""",
    "scan_slots": f"""with {_SLOTS}
select date_brute as date, id_centre, nom_centre, cp_centre, nb_heures, nb_lignes, nb_creneaux,
  type_vaccin, operateur from filled""",
    "published_scan": _BOOKINGS,
    "centre_day_scan": _CENTRE_DAY,
    "region_split": f"""select *, region as region_part
from ({_ars("where region <> 'MAY'")}) q""",
    # Jobs
    "job_bookings": _BOOKINGS,
    "job_rejects": f"""with {_TAGGED}
select {_RAW_COLUMNS}, motif_rejet, date '2021-12-17' as date_traitement
from tagged where motif_rejet is not null""",
    "job_error_report": f"""with {_TAGGED}
select operateur, count(*) as tot_row, count(motif_rejet) as err_row,
  count(motif_rejet) / count(*) > 0.001 as alerte,
  count(*) filter (where motif_rejet is null and id_centre is null) as nb_id_centre_absent,
  count(*) filter (where motif_rejet is null and annee_naissance is null) as nb_annee_naissance_absente,
  max(year(jour)) filter (where motif_rejet is null) as annee_max
from tagged group by operateur""",
    "job_publication": _PUBLISHED,
    "job_publication_partials": _PUBLISHED,
    "job_controls": _SUMMARY,
    "job_slots": f"with {_SLOTS} select {_SLOT_COLUMNS} from slots",
    "slot_figures": f"""with {_SLOTS}
select operateur, count(*) as tot_row, count(*) - count(cp_centre) as nb_cp_centre_absent,
  count(*) - count(date) as nb_date_illisible
from slots group by operateur""",
    # Incremental ingest
    "ingest_bookings": _BOOKINGS,
    "ingest_centre_day": _CENTRE_DAY,
    "ingest_corrected": _BOOKINGS,
}

# Figures of one feed, by the columns of the report.
_FIGURES = """count(*) as tot_row, count(motif_rejet) as err_row,
  count(motif_rejet) / count(*) > 0.001 as alerte,
  count(*) filter (where motif_rejet is null and id_centre is null) as nb_id_centre_absent,
  count(*) filter (where motif_rejet is null and annee_naissance is null) as nb_annee_naissance_absente,
  max(year(jour)) filter (where motif_rejet is null) as annee_max"""

ORACLES |= {
    "ingest_rejects": ORACLES["job_rejects"],
    "ingest_error_report": ORACLES["job_error_report"],
    "job_daily_file": _ars(),
    "job_regions": ORACLES["region_split"],
    "job_exclusions": ORACLES["excluded_null_keys"],
    "job_dimension": f"""with {_NORMALIZED}
select {_COLUMNS.replace("region, motif", "case when region = 'IDF' then 'ILE' else region end as region, motif")}
from norm""",
    "job_missing_and_rejected": f"""with {_TAGGED}
select operateur, {_FIGURES}, max(year(jour)) filter (where motif_rejet is null) >= 2022 as rdv_2022_ou_apres,
  true as publie_un_vendredi
from tagged where operateur = 'maiia' group by operateur
union all
select operateur, count(*), count(*), true, 0, 0, null, false, true
from tagged where operateur = 'keldoc' group by operateur
union all
select 'doctolib', 0, 0, false, 0, 0, null, false, true""",
    "scan_parts": f"""with raw as ({RAW_BOOKINGS_SQL})
select * exclude (rdv_id) replace (
  case when operateur = 'doctolib' then 'NR' else annee_naissance end as annee_naissance,
  case when operateur = 'doctolib' and (rdv_id // 3) % 2 = 1 then 'NR' else motif_rdv end as motif_rdv)
from raw""",
    "published_order": f"""
select niveau, count(*) as lignes, 0 as deplacees from ({_PUBLISHED}) q group by niveau
union all
select 'ars', count(*), 0 from ({_ars()}) q""",
    "operator_whitelist": """
with noms as (select o_orderkey, ['maiia', 'keldoc', 'doctolib', 'Maiia', 'autre', ''][o_orderkey % 6 + 1] as operateur
  from orders)
select o_orderkey, operateur, operateur in ('maiia', 'keldoc', 'doctolib') as connu from noms""",
    "date_bounds": """
with textes as (
  select o_orderkey as rdv_id, case when o_orderkey % 2 = 0
    then ['1677-09-21', '1677-09-22', '1677-10-01', '2262-02-01', '2262-04-11', '2262-04-12', '9999-12-31',
      '0001-01-01'][o_orderkey % 8 + 1]
    else cast(cast(o_orderdate as date) as varchar) end as brut
  from orders
)
select rdv_id, brut, case when cast(brut as date) between date '1677-09-22' and date '2262-04-11'
  then cast(brut as date) end as jour
from textes""",
}
