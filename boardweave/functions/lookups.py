"""Fixed values the conformance functions read.

Everything in this module is data: vocabularies, patterns, rates, bounds. The
values are part of the observable output, so they are stated once, here, and
nowhere else. Logic that uses them lives in the sibling modules.
"""

# --- fixed values: money ---------------------------------------------------

# one unit of the currency, in US dollars; pinned so that re-runs agree
FX_TO_USD = {
    "USD": 1.00, "EUR": 1.10, "GBP": 1.28, "CHF": 1.25,
    "CAD": 0.74, "AUD": 0.67, "NZD": 0.61, "JPY": 0.0068,
    "CNY": 0.14, "KRW": 0.00074, "TWD": 0.033, "HKD": 0.128,
    "SGD": 0.75, "MYR": 0.22, "THB": 0.028, "VND": 0.000039,
    "PHP": 0.0177, "IDR": 0.000062, "INR": 0.0117, "AED": 0.272,
    "ILS": 0.27, "TRY": 0.028, "RUB": 0.011, "UAH": 0.024,
    "PLN": 0.26, "CZK": 0.044, "HUF": 0.0028, "RON": 0.22,
    "SEK": 0.10, "DKK": 0.148, "NOK": 0.095, "BRL": 0.185,
    "MXN": 0.055, "PEN": 0.27, "COP": 0.00024, "CLP": 0.0011,
    "ZAR": 0.055, "BHD": 2.65, "AMD": 0.0026, "BYN": 0.31,
}
FX_AS_OF = "2026-08"

# pay periods and how many of each make a paid year
PERIOD_TO_ANNUAL = {
    "yearly": 1.0,
    "monthly": 12.0,
    "weekly": 52.0,
    "daily": 260.0,
    "hourly": 2080.0,
}

# an annual US-dollar figure outside these bounds is a data error
ANNUAL_USD_MIN = 1_000
ANNUAL_USD_MAX = 5_000_000

# with no usable period, a midpoint below these US-dollar amounts is read as
# hourly, then monthly; anything larger is yearly
HOURLY_BELOW_USD = 150
MONTHLY_BELOW_USD = 15_000

# --- fixed values: enum ordinals of the first schema generation ------------

EMPLOYMENT_ORDINALS = {
    0: "FullTime", 1: "PartTime", 2: "Contract", 3: "Freelance",
    4: "Internship", 5: "Seasonal", 6: "Temporary",
}
EMPLOYMENT_NAMES = {
    "FullTime": "full_time", "PartTime": "part_time", "Contract": "contract",
    "Freelance": "freelance", "Internship": "internship",
    "Seasonal": "seasonal", "Temporary": "temporary",
}
STATUS_ORDINALS = {
    0: "Draft", 1: "Active", 2: "Paused", 3: "Filled", 4: "Expired", 5: "Closed",
}
ROLE_ORDINALS = {
    0: "Barista", 1: "HeadBarista", 2: "Roaster", 3: "HeadRoaster",
    4: "GreenBuyer", 5: "QGrader", 6: "Farmer", 7: "FarmManager",
    8: "EquipmentTech", 9: "CafeOwner", 10: "CafeManager", 11: "Trainer",
    12: "Consultant", 13: "SalesRep", 14: "Importer", 15: "Exporter",
    16: "Distributor", 17: "Agronomist", 18: "LabTechnician",
    19: "ProductionManager", 20: "Other",
}
CATEGORY_ORDINALS = {
    0: "BaristaAndCafeStaff", 1: "RoastingAndProduction",
    2: "GreenCoffeeAndTrading", 3: "QualityControl",
    4: "EducationAndTraining", 5: "SalesAndMarketing", 6: "FarmAndOrigin",
    7: "EquipmentAndTechnical", 8: "ManagementAndOperations",
}
COMPANY_TYPE_ORDINALS = {
    0: "Cafe", 1: "Roastery", 2: "CafeRoastery", 3: "Importer", 4: "Exporter",
    5: "Farm", 6: "Cooperative", 7: "EquipmentManufacturer",
    8: "EquipmentDistributor", 9: "TrainingCenter", 10: "Consultancy",
    11: "Laboratory", 12: "Bistro", 13: "Restaurant", 14: "Bakery", 15: "Hotel",
}
ENUM_TABLES = {
    "role_type": ROLE_ORDINALS,
    "category": CATEGORY_ORDINALS,
    "employment_type": EMPLOYMENT_ORDINALS,
    "status": STATUS_ORDINALS,
    "company_type": COMPANY_TYPE_ORDINALS,
}

# --- fixed values: ordered keyword rules, first match wins ------------------

EMPLOYMENT_RULES = [
    (r"intern(ship)?\b|\bstage\b|praktik", "internship"),
    (r"apprentice|ausbildung|alternan|apprentissage|\blehr", "apprenticeship"),
    (r"volunt|b[eé]n[eé]volat|unremunerated", "volunteer"),
    (r"season|saison", "seasonal"),
    (r"freelance|self.?employed|independent\b|\bzzp\b|freie mitarbeit|業務委託", "freelance"),
    (r"\btemp\b|temporary|zeitarbeit|per diem|\bprn\b|casual|määräaikainen|intermittent", "temporary"),
    (r"contract|\bcdd\b|fixed.?term|\bftc\b|interim|int[eé]rim|detachering|consultant|contrat|契約社員", "contract"),
    (r"full.?time|fulltime|vollzeit|voltijd|permanent|\bcdi\b|unbefristet|festanstellung|\bvast\b|正社員|indefinite|\bregular\b|employee|フルタイム", "full_time"),
    (r"part.?time|parttime|teilzeit|deeltijd|パート|アルバイト|minijob|werkstudent|working student", "part_time"),
]
SENIORITY_RULES = [
    (r"executive|\bchief\b|\bvp\b|c.?level|board", "executive"),
    (r"director", "director"),
    (r"manager\b|head of", "manager"),
    (r"\blead\b|principal|\bstaff\b|team lead", "lead"),
    (r"senior|\bsr\b|シニア|ervaren", "senior"),
    (r"medior|intermediate|\bmid\b|mid.?level|middle|professional|experienced|berufserfahren", "mid"),
    (r"entry|junior|\bjr\b|early|graduate|trainee|working student|associate\b|starter", "entry"),
    (r"intern", "internship"),
]
REMOTE_PATTERN = r"remote|home.?office|homeoffice|t[eé]l[eé]travail|fully remote|100% remote|anywhere|work from home|wfh"
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
EMAIL_MASK = "[email-redacted]"

# --- fixed values: canonical vocabularies -----------------------------------

EMPLOYMENT_TYPES = (
    "full_time", "part_time", "contract", "temporary", "internship",
    "apprenticeship", "freelance", "seasonal", "volunteer", "other", "unknown",
)
SENIORITIES = (
    "internship", "entry", "mid", "senior", "lead", "manager", "director",
    "executive", "unknown",
)
STATUSES = ("draft", "active", "paused", "filled", "expired", "closed", "unknown")

# --- fixed values: geography -------------------------------------------------

COUNTRY_NAMES = {
    "united states": "US", "usa": "US", "us": "US", "u.s.": "US",
    "united states of america": "US", "united kingdom": "GB", "uk": "GB",
    "great britain": "GB", "england": "GB", "scotland": "GB", "wales": "GB",
    "northern ireland": "GB", "germany": "DE", "deutschland": "DE",
    "france": "FR", "netherlands": "NL", "the netherlands": "NL",
    "nederland": "NL", "switzerland": "CH", "schweiz": "CH", "suisse": "CH",
    "austria": "AT", "österreich": "AT", "belgium": "BE", "belgië": "BE",
    "spain": "ES", "españa": "ES", "italy": "IT", "italia": "IT",
    "ireland": "IE", "portugal": "PT", "poland": "PL", "polska": "PL",
    "czech republic": "CZ", "czechia": "CZ", "denmark": "DK", "sweden": "SE",
    "norway": "NO", "finland": "FI", "greece": "GR", "hungary": "HU",
    "romania": "RO", "bulgaria": "BG", "slovakia": "SK", "slovenia": "SI",
    "croatia": "HR", "lithuania": "LT", "latvia": "LV", "estonia": "EE",
    "luxembourg": "LU", "japan": "JP", "日本": "JP", "china": "CN",
    "south korea": "KR", "korea": "KR", "taiwan": "TW", "hong kong": "HK",
    "singapore": "SG", "malaysia": "MY", "thailand": "TH", "vietnam": "VN",
    "viet nam": "VN", "philippines": "PH", "indonesia": "ID", "india": "IN",
    "united arab emirates": "AE", "uae": "AE", "israel": "IL", "turkey": "TR",
    "türkiye": "TR", "russia": "RU", "ukraine": "UA", "brazil": "BR",
    "brasil": "BR", "mexico": "MX", "méxico": "MX", "peru": "PE",
    "colombia": "CO", "chile": "CL", "argentina": "AR", "canada": "CA",
    "australia": "AU", "new zealand": "NZ", "south africa": "ZA",
    "bahrain": "BH", "armenia": "AM", "belarus": "BY",
}
US_STATES = tuple(
    "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY "
    "NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY DC".split()
)
EURO_COUNTRIES = tuple("DE FR NL AT BE ES IT IE PT FI GR LU SK SI HR LT LV EE".split())
COUNTRY_CURRENCY = {
    "US": "USD", "GB": "GBP", "CH": "CHF", "CA": "CAD", "AU": "AUD",
    "NZ": "NZD", "JP": "JPY", "CN": "CNY", "KR": "KRW", "TW": "TWD",
    "HK": "HKD", "SG": "SGD", "MY": "MYR", "TH": "THB", "VN": "VND",
    "PH": "PHP", "ID": "IDR", "IN": "INR", "AE": "AED", "IL": "ILS",
    "TR": "TRY", "RU": "RUB", "UA": "UAH", "PL": "PLN", "CZ": "CZK",
    "HU": "HUF", "RO": "RON", "SE": "SEK", "DK": "DKK", "NO": "NOK",
    "BR": "BRL", "MX": "MXN", "PE": "PEN", "CO": "COP", "CL": "CLP",
    "ZA": "ZAR", "BH": "BHD", "AM": "AMD", "BY": "BYN",
    **dict.fromkeys(EURO_COUNTRIES, "EUR"),
}
