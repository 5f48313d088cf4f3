"""The daily health-records star schema: one location dimension and five daily facts.

The wide daily file has one row per (``iso_code``, ``date``) with 67 text columns; these
mappings say where each column lands. They are data for the generic operators, nothing
more: ``stellate.plans.load.load_wide_file(..., HEALTH)`` runs the whole load.
"""

from __future__ import annotations

from stellate.operators.mapping import table
from stellate.plans.load import StarSchema

# ---------------------------------------------------------------------------------------
# Target table names, column names and types of the published schema, and
# the source column feeding each, in table order. Types: text, bigint (strict cast),
# bigint_round (double, rounded half to even), double, date.
# ---------------------------------------------------------------------------------------
ENTITY = "iso_code"
DATE = "date"
LABEL = "location"

LOCATII = table(
    "locatii",
    keys=[("iso_code", "cod_iso", "text")],
    columns=[
        ("location", "denumire", "text", False),
        ("continent", "continent", "text"),
        ("population", "populatie", "bigint_round"),
        ("population_density", "densitate_populatie", "double"),
        ("median_age", "varsta_mediana", "double"),
        ("aged_65_older", "procent_65_plus", "double"),
        ("aged_70_older", "procent_70_plus", "double"),
        ("gdp_per_capita", "pib_pe_cap", "double"),
        ("extreme_poverty", "saracie_extrema", "double"),
        ("cardiovasc_death_rate", "rata_decese_cardiovasculare", "double"),
        ("diabetes_prevalence", "prevalenta_diabet", "double"),
        ("female_smokers", "fumatoare_proc", "double"),
        ("male_smokers", "fumatori_proc", "double"),
        ("handwashing_facilities", "facilitati_spalare_maini", "double"),
        ("hospital_beds_per_thousand", "paturi_spital_la_mie", "double"),
        ("life_expectancy", "speranta_viata", "double"),
        ("human_development_index", "indice_dezvoltare_umana", "double"),
    ],
)

_FACT_KEYS = [("iso_code", "cod_iso", "text"), ("date", "data", "date")]

CAZURI_ZILNICE = table(
    "cazuri_zilnice",
    keys=_FACT_KEYS,
    columns=[
        ("total_cases", "total_cazuri", "bigint"),
        ("new_cases", "cazuri_noi", "double"),
        ("new_cases_smoothed", "cazuri_noi_netezite", "double"),
        ("total_deaths", "total_decese", "bigint"),
        ("new_deaths", "decese_noi", "double"),
        ("new_deaths_smoothed", "decese_noi_netezite", "double"),
        ("total_cases_per_million", "total_cazuri_la_milion", "double"),
        ("new_cases_per_million", "cazuri_noi_la_milion", "double"),
        ("new_cases_smoothed_per_million", "cazuri_noi_netezite_la_milion", "double"),
        ("total_deaths_per_million", "total_decese_la_milion", "double"),
        ("new_deaths_per_million", "decese_noi_la_milion", "double"),
        ("new_deaths_smoothed_per_million", "decese_noi_netezite_la_milion", "double"),
        ("reproduction_rate", "rata_reproductie", "double"),
        ("stringency_index", "indice_strictete", "double"),
    ],
)

SPITALIZARI_ZILNICE = table(
    "spitalizari_zilnice",
    keys=_FACT_KEYS,
    columns=[
        ("icu_patients", "pacienti_uti", "double"),
        ("icu_patients_per_million", "pacienti_uti_la_milion", "double"),
        ("hosp_patients", "pacienti_spital", "double"),
        ("hosp_patients_per_million", "pacienti_spital_la_milion", "double"),
        ("weekly_icu_admissions", "internari_uti_saptamanale", "double"),
        ("weekly_icu_admissions_per_million", "internari_uti_saptamanale_la_milion", "double"),
        ("weekly_hosp_admissions", "internari_spital_saptamanale", "double"),
        ("weekly_hosp_admissions_per_million", "internari_spital_saptamanale_la_milion", "double"),
    ],
)

TESTARI_ZILNICE = table(
    "testari_zilnice",
    keys=_FACT_KEYS,
    columns=[
        ("total_tests", "total_testari", "bigint"),
        ("new_tests", "testari_noi", "double"),
        ("total_tests_per_thousand", "total_testari_la_mie", "double"),
        ("new_tests_per_thousand", "testari_noi_la_mie", "double"),
        ("new_tests_smoothed", "testari_noi_netezite", "double"),
        ("new_tests_smoothed_per_thousand", "testari_noi_netezite_la_mie", "double"),
        ("positive_rate", "rata_pozitivitate", "double"),
        ("tests_per_case", "teste_pe_caz", "double"),
        ("tests_units", "unitati_testare", "text"),
    ],
)

VACCINARI_ZILNICE = table(
    "vaccinari_zilnice",
    keys=_FACT_KEYS,
    columns=[
        ("total_vaccinations", "total_vaccinari", "bigint"),
        ("people_vaccinated", "persoane_vaccinate", "bigint"),
        ("people_fully_vaccinated", "persoane_vaccinate_complet", "bigint"),
        ("total_boosters", "total_boostere", "bigint"),
        ("new_vaccinations", "vaccinari_noi", "double"),
        ("new_vaccinations_smoothed", "vaccinari_noi_netezite", "double"),
        ("total_vaccinations_per_hundred", "total_vaccinari_la_suta", "double"),
        ("people_vaccinated_per_hundred", "persoane_vaccinate_la_suta", "double"),
        ("people_fully_vaccinated_per_hundred", "persoane_vaccinate_complet_la_suta", "double"),
        ("total_boosters_per_hundred", "total_boostere_la_suta", "double"),
        ("new_vaccinations_smoothed_per_million", "vaccinari_noi_netezite_la_milion", "double"),
        ("new_people_vaccinated_smoothed", "persoane_noi_vaccinate_netezite", "double"),
        ("new_people_vaccinated_smoothed_per_hundred", "persoane_noi_vaccinate_netezite_la_suta", "double"),
    ],
)

MORTALITATE_EXCES_ZILNICA = table(
    "mortalitate_exces_zilnica",
    keys=_FACT_KEYS,
    columns=[
        ("excess_mortality_cumulative_absolute", "mortalitate_exces_cumulata_absoluta", "double"),
        ("excess_mortality_cumulative", "mortalitate_exces_cumulata", "double"),
        ("excess_mortality", "mortalitate_exces", "double"),
        ("excess_mortality_cumulative_per_million", "mortalitate_exces_cumulata_la_milion", "double"),
    ],
)

# Load order of the facts (the dimension is always loaded first).
FACTS = (CAZURI_ZILNICE, TESTARI_ZILNICE, VACCINARI_ZILNICE, SPITALIZARI_ZILNICE, MORTALITATE_EXCES_ZILNICA)

HEALTH = StarSchema(entity=ENTITY, date=DATE, label=LABEL, dimension=LOCATII, facts=FACTS)

# All 67 source columns, derived from the mappings (keys once).
SOURCE_COLUMNS = [ENTITY, DATE] + [c.source for c in LOCATII.columns] + [
    c.source for f in FACTS for c in f.columns
]
