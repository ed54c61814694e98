"""Fixed values the surveillance jobs depend on.

Everything here is a plain lookup value (word list, code list, label, spelling
fix).  Changing one changes results, so they are kept together and in their
natural order.
"""

from __future__ import annotations

import datetime as dt

# --- fixed values: dates and windows ------------------------------------------
FIRST_DATE = dt.date(2019, 12, 1)
WEEK_SPAN = 6        # a 7-day window includes the reference day
MONTH_SPAN = 29      # a 30-day window includes the reference day
SERIES_SPAN = 89     # a 90-day window includes the reference day
CONFIDENCE = 0.95

# --- fixed values: columns of the full metadata extract -----------------------
METADATA_COLUMNS = (
    "Virus name", "Type", "Accession ID", "Collection date", "Location",
    "Additional location information", "Sequence length", "Host",
    "Patient age", "Gender", "Clade", "Pango lineage", "Pangolin version",
    "Variant", "AA Substitutions", "Submission date", "Is reference?",
    "Is complete?", "Is high coverage?", "Is low coverage?", "N-Content",
    "GC-Content",
)

# --- fixed values: sequence quality limits -------------------------------------
MIN_SEQUENCE_LENGTH = 20000
MAX_N_CONTENT = 0.02
GC_LOW, GC_HIGH = 0.25, 0.40
HUMAN_HOST = "Human"
EXCLUSION_PREFIX = "hCoV-19/"

# --- fixed values: aggregate codes dropped from the case series ----------------
AGGREGATE_CODES_9 = (
    "OWID_AFR", "OWID_ASI", "OWID_EUR", "OWID_EUN", "OWID_INT", "OWID_NAM",
    "OWID_OCE", "OWID_SAM", "OWID_WRL",
)
AGGREGATE_CODES_15 = (
    "OWID_AFR", "OWID_ASI", "OWID_EUR", "OWID_EUN", "OWID_INT", "OWID_NAM",
    "OWID_OCE", "OWID_SAM", "OWID_WRL", "OWID_CYN", "OWID_HIC", "OWID_KOS",
    "OWID_LIC", "OWID_LMC", "OWID_UMC",
)
REGION_OF_AGGREGATE_CODE = {
    "OWID_AFR": "Africa",
    "OWID_ASI": "Asia",
    "OWID_EUR": "Europe",
    "OWID_NAM": "North America",
    "OWID_OCE": "Oceania",
    "OWID_SAM": "South America",
    "OWID_WRL": "Global",
}

# --- fixed values: location spelling ---------------------------------------------
LOWERCASE_WORDS = ("and", "or", "the", "a", "of", "in", "d'Ivoire")
USA_MARK = "usa"
USA_NAME = "United States"
COUNTRY_FIXES_TITLECASED = {
    "Puerto Rico": "United States",
    "Guam": "United States",
    "Northern Mariana Islands": "United States",
    "U.s. Virgin Islands": "United States",
    "Czech Republic": "Czechia",
    "Antigua": "Antigua and Barbuda",
    "Democratic Republic of the Congo": "Democratic Republic of Congo",
    "Republic of the Congo": "Congo",
    "Faroe Islands": "Faeroe Islands",
    "Guinea Bissau": "Guinea-Bissau",
    "Niogeria": "Nigeria",
    "Bosni and Herzegovina": "Bosnia and Herzegovina",
    "England": "United Kingdom",
    "The Bahamas": "Bahamas",
}
COUNTRY_FIXES_BEFORE_CAPITAL = {"USA": "United States", "Usa": "United States"}
COUNTRY_FIXES_AFTER_CAPITAL = {
    "Cote dIvoire": "Cote d'Ivoire",
    "Niogeria": "Nigeria",
    "Republic of the Congo": "Congo",
    "Czech republic": "Czech Republic",
    "Jonavos apskritis": "Lithuania",
    "M?xico": "Mexico",
}
DIVISION_FIXES = {"DC": "District of Columbia"}
TRACKER_NAME_FIXES = {"Réunion (France)": "Réunion"}

# --- fixed values: country codes a name lookup does not find ----------------------
LINE_LIST_CODE_OVERRIDES = {
    "Micronesia (country)": "FSM",
    "Timor": "TLS",
    "Turks and Caicos Islands": "TCA",
    "Nauru": "NRU",
    "Kosovo": "XKX",
    "Guernsey": "GGY",
    "Falkland Islands": "FLK",
}
TESTING_CODE_OVERRIDES = {"Kosovo": "XKX", "Namibia": "NAM"}

# --- fixed values: country names -----------------------------------------------------
NAME_ABBREVIATIONS = {
    "st": "saint", "ste": "saint", "dem": "democratic", "rep": "republic", "fed": "federated",
    "sts": "states", "pdr": "democratic",
}
NAME_CONNECTORS = ("and", "the", "of", "island", "islands", "isl", "is")
# Ways to name a country: words that a name holds, in any order; words with - bar it.
COUNTRY_NAME_RULES = {
    "ARE": ("united arab emirates", "emirates", "uae"),
    "ATG": ("antigua", "barbuda"),
    "BES": ("bonaire", "caribbean netherlands"),
    "BIH": ("bosnia", "herzegovina"),
    "BLR": ("belarus", "byelorussia", "belorussia"),
    "BRN": ("brunei",),
    "CAF": ("central african",),
    "CHN": ("china -taiwan -taipei -hong -hongkong -macao -macau",),
    "CIV": ("ivoire", "divoire", "ivory coast"),
    "COD": ("congo democratic", "congo kinshasa", "congo dr", "congo drc", "drc", "zaire"),
    "COG": ("congo", "congo brazzaville"),
    "CPV": ("cape verde", "cabo verde"),
    "CZE": ("czechia", "czech -slovak -slovakia"),
    "DOM": ("dominican",),
    "FLK": ("falkland", "falklands", "malvinas"),
    "FRA": ("france -reunion -martinique -guadeloupe -guiana -mayotte -polynesia -caledonia",),
    "FRO": ("faroe", "faeroe", "faroes"),
    "FSM": ("micronesia",),
    "GBR": ("united kingdom", "uk", "britain"),
    "HKG": ("hong kong", "hongkong"),
    "IRL": ("ireland -northern -north",),
    "JEY": ("jersey -new",),
    "KGZ": ("kyrgyzstan", "kyrgyz", "kirghizia"),
    "KHM": ("cambodia", "kampuchea"),
    "KNA": ("saint kitts", "saint christopher nevis"),
    "KOR": ("korea -north -democratic -peoples -dprk", "korea south", "korea republic -democratic -peoples"),
    "LAO": ("lao", "laos"),
    "LBY": ("libya", "libyan"),
    "LKA": ("sri lanka", "ceylon"),
    "MAC": ("macao", "macau"),
    "MDA": ("moldova", "moldavia"),
    "MEX": ("mexico -new",),
    "MKD": ("macedonia",),
    "MMR": ("myanmar", "burma"),
    "MNP": ("northern mariana", "marianas"),
    "NLD": ("netherlands -antilles", "holland"),
    "PRK": ("korea north", "korea democratic", "korea peoples", "dprk"),
    "PSE": ("palestine", "palestinian", "west bank", "gaza"),
    "ROU": ("romania", "rumania", "roumania"),
    "RUS": ("russia", "russian"),
    "SGS": ("south georgia",),
    "SJM": ("svalbard", "jan mayen"),
    "STP": ("sao tome",),
    "SVK": ("slovakia", "slovak -czech"),
    "SWZ": ("eswatini", "swaziland"),
    "SXM": ("sint maarten", "saint maarten"),
    "SYR": ("syria", "syrian"),
    "TLS": ("timor",),
    "TTO": ("trinidad", "tobago"),
    "TUR": ("turkey", "turkiye"),
    "TWN": ("taiwan", "taipei"),
    "UMI": ("united states outlying", "us outlying"),
    "USA": ("united states", "usa", "us"),
    "VAT": ("vatican", "holy see"),
    "VCT": ("saint vincent",),
    "VGB": ("british virgin", "virgin uk"),
    "VIR": ("us virgin", "united states virgin"),
    "VNM": ("vietnam", "viet nam"),
    "WLF": ("wallis", "futuna"),
}
# The continents of the case file that are one in the country list.
CONTINENT_MERGES = {"North America": "Americas", "South America": "Americas"}

# --- fixed values: lineages ---------------------------------------------------------
VARIANT_GROUPS = {
    "who_alpha": ("B.1.1.7", "Q.*"),
    "who_beta": ("B.1.351", "B.1.351.2", "B.1.351.3", "B.1.351.4", "B.1.351.5"),
    "who_gamma": ("P.1", "P.1.*"),
    "who_delta": ("B.1.617.2", "AY.*"),
    "who_omicron": ("B.1.1.529", "B.1.1.529.*", "BA.*"),
    "who_allvois": ("C.37", "C.37.1", "B.1.621", "B.1.621.1"),
}
OTHER_KEY_LINEAGES = (
    "B.1.617.3", "B.1.427", "B.1.429", "B.1.427/429", "B.1.525", "B.1.526",
    "B.1.526.*", "B.1.617.1", "P.2", "P.3",
)
LINEAGE_MERGES = {"B.1.427": "B.1.427/429", "B.1.429": "B.1.427/429"}
ALL_LINEAGES = "All lineages"
OTHER_LINEAGES = "Other lineages"

# --- fixed values: report labels ------------------------------------------------------
GLOBAL_LABEL = "Global"
WHO_REGION_PREFIX = "WHO Region: "
NO_RECENT_SEQUENCES = "No sequences were submitted from last week"
INSUFFICIENT_SEQUENCING = "not estimated, insufficient recent sequencing"
MINIMAL_CASES = "minimal recent COVID cases"
TABLE_END_MARK = "total (worldwide)"
TABLE_WIDTH = 7
TOPLINE_LABELS = {
    # type: (metric text, compared with)
    "omicroncases": ("Cumulative confirmed Omicron cases", "Last week"),
    "countries": ("Countries/territories with confirmed Omicron case(s)", "Last week"),
    "global_cases": ("Total Covid-19 cases reported in the last 7 days", "Last week"),
    "pct_cases_seq": (
        "Percent of Covid-19 cases sequenced in the last 30 days*", "30 days ago"),
}
CAROUSEL_ROWS = {
    # topline column: (metric text, source, display order)
    "n_cases_all": ("Confirmed Omicron cases", "GISAID & BNO News", 1),
    "n_countries_all": ("Countries with Omicron case(s)", "GISAID & BNO News", 2),
    "n_seq": ("Genomic Sequences submitted to GISAID", "GISAID", 3),
    "daily_inc_all_cases": ("Daily Increase in Total Omicron Case(s)", "GISAID & BNO News", 4),
    "daily_inc_countries": (
        "Daily Increase of Countries with Omicron case(s)", "GISAID & BNO News", 5),
    "daily_inc_seq": (
        "Daily Increase of Genomic Sequences submitted to GISAID", "GISAID", 6),
}
