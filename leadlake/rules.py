"""Rule packs: the vocabulary that operators are given as data. Pass your own to any operator."""

from __future__ import annotations

from dataclasses import dataclass

# Vocabulary, patterns and key sets whose content decides results.
TRACKING_KEYS = ("fbclid", "gclid", "igshid", "mc_cid", "mc_eid", "mkt_tok", "ref", "ref_src", "source", "spm", "trk")
TRACKING_PREFIXES = ("utm_",)
FAMILY_RULES = (
    ("pre-college", "college-pre-college"), ("precollege", "college-pre-college"), ("young global scholars", "college-pre-college"), ("summer school", "college-pre-college"),
    ("academic", "academic"), ("engineering", "stem"), ("stem", "stem"), ("robotics", "stem"), ("coding", "stem"), ("science", "stem"), ("music", "music"), ("band", "music"),
    ("arts", "arts"), ("theater", "arts"), ("dance", "arts"), ("sport", "sports"), ("soccer", "sports"), ("baseball", "sports"), ("basketball", "sports"),
    ("faith", "faith-based"), ("church", "faith-based"), ("retreat", "faith-based"), ("family camp", "family"), ("family retreat", "family"), ("adventure", "adventure"), ("wilderness", "wilderness"),
)
CAMP_TYPE_RULES = (("overnight", "overnight"), ("residential", "residential"), ("on campus", "residential-academic"), ("live on campus", "residential-academic"), ("dorm", "residential-academic"), ("residence hall", "residential-academic"))
ENROL_PHRASES = ("open for summer", "registration is open", "enroll now", "apply now")
MULTI_VENUE_PHRASES = ("multiple", "various", "different campuses", "multiple residential sites", "multi-site")
PENDING_PHRASES = ("to be confirmed", "pending", "residential sites", "campus / residential sites")
VENUE_PLACEHOLDERS = ("venue to be confirmed", "unknown")
AMOUNT_PATTERN = r"(?i)(?:CAD|CA\$|MXN|MX\$|USD|US\$|\$)\s*([\d,]+(?:\.\d+)?)"
CURRENCY_PATTERNS = ((r"(?i)(?:CAD|CA?\$)\s*[\d,]+", "CAD"), (r"(?i)(?:MXN|MX?\$)\s*[\d,]+", "MXN"), (r"(?i)(?:USD|US?\$)\s*[\d,]+", "USD"), (r"\$\s*[\d,]+", "USD"))
AMOUNT_YEARS = (2020, 2034)
EMAIL_PATTERN = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
PHONE_PATTERN = r"(?:\+?1[\s.-]?)?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}|(?:\+\d{1,3}[\s.-]?)?\d[\d\s.\-()]{7,14}\d"
JUNK_EMAIL_PARTS = ("example.com", "sentry", "webpack", "schema.org", "noreply", "no-reply", "donotreply", ".png", ".jpg", "placeholder", "test@", "wixpress")
AGE_RANGE_PATTERN = r"(?i)ages?\s*(\d{1,2})\s*[-–to]+\s*(\d{1,2})"
GRADE_RANGE_PATTERN = r"(?i)(\d{1,2})(?:st|nd|rd|th)?\s*(?:[-–]|through|to)\s*(\d{1,2})(?:st|nd|rd|th)?\s*grade"
GRADE_SINGLE_PATTERN = r"(?i)(?:grade|gr\.?)\s*(\d{1,2})"
DAYS_PATTERN = r"(?i)(\d{1,3})\s*(?:day|night)"
WEEKS_PATTERN = r"(?i)(\d{1,2})\s*[-\s]?week"
PRICE_WORDS = ("tuition", "cost", "price", "fee", "rate", "registration", "pricing", "payment", "invest", "tarifa", "costo", "precio")
BOARDING_WORDS = ("all-inclusive", "including", "includes", "boarding", "accommodation", "meals", "housing", "lodging", "room and board", "room & board")
KNOWN_FAMILIES = ("college-pre-college", "academic", "stem", "music", "arts", "sports", "faith-based", "family", "traditional", "adventure", "wilderness")
KNOWN_TYPES = ("overnight", "residential", "residential-academic")
BASIS_NAMES = {
    "single_venue_candidate": "venue_candidate", "venue_unconfirmed": "venue_candidate_pending_confirmation", "multi_venue_candidate": "multi_venue_candidate",
    "venue_candidate": "venue_candidate", "venue_candidate_pending_confirmation": "venue_candidate_pending_confirmation",
}
BASIS_RANK = {"venue_candidate": 0, "venue_candidate_pending_confirmation": 1, "multi_venue_candidate": 2}
DRAFT_STATUS = {"venue_candidate": "candidate", "venue_candidate_pending_confirmation": "candidate_pending", "multi_venue_candidate": "multi_venue"}
NO_CITY = ("", "unknown", "unknown city", "city to be confirmed", "unk")
NO_VENUE = ("", "unknown", "venue to be confirmed")
PENDING_WORDS = ("unknown", "pending", "to be confirmed", "tbd", "venue to be confirmed", "city to be confirmed")
PENDING_REASONS = ("pending_venue_confirmation", "unknown_venue", "unknown_city")
HELPER_SUFFIXES = (
    "_summary.json", "_README.md", "_queries.jsonl", "_queries_probe.jsonl", "_raw.jsonl", "_raw_probe.jsonl", "_evidence_index.jsonl", "_followup_queue.jsonl", "_split_queue.jsonl", "_split_stubs.jsonl",
)
HELPER_KEYS = ("candidate_ids", "candidate_names", "queries", "matched_reason", "matched_reasons")
RAW_KEYS = ("url", "title", "query", "source", "provider")
CANDIDATE_HELPER_KEYS = ("queries", "matched_reason", "matched_reasons", "search_query", "candidate_ids")
CANDIDATE_KEYS = ("name", "candidate_name", "canonical_url", "record_basis", "program_family", "program_family_tags")
FOLLOWUP_TEXTS = {
    "split_multi_venue_candidate": ("high", "One row stands for several venues.", "List the venues and make a row for each."),
    "confirm_exact_venue": ("high", "It is not known at which venue this takes place.", "Look for the property or campus by name."),
    "capture_pricing": ("medium", "No price is known.", "Look for fees, deposits, and whether board is part of them."),
    "capture_contact": ("medium", "Nobody to ask is known.", "Look for an e-mail address, a telephone number or a contact page."),
    "confirm_recent_activity": ("high", "Nothing shows that this ran lately.", "Look for dates or open registration of this or the last season."),
    "confirm_overnight": ("high", "Nothing says that participants stay the night.", "Look for words about rooms, cabins or board on the operator's own pages."),
    "duplicate_review": ("medium", "Several rows have this address.", "Compare them: one venue, or pages of one site?"),
    "priority_review_college_precollege": ("medium", "A pre-college program, which this catalog looks for most.", "Check this row before others."),
    "priority_review_one_week_plus": ("medium", "A week or longer, which this catalog looks for most.", "Check the length before other fields."),
}
SPLIT_STEP = "Name the venues of this candidate, then add a candidate for each."
SPLIT_NOTES = ("Stub of a candidate with several venues.", "Copy it once for every venue that is found.")
OPERATOR_TYPES = (
    ("university", ("university", "college", "summer school", "academy", "school of")), ("ymca", ("ymca",)), ("faith-based", ("church", "synagogue", "ministr", "faith", "christian", "jewish")), ("camp-operator", ("camp",)),
)
META_PHRASES = (
    "lead", "leads", "ecosystem", "directory", "member network", "association", "sample seeded dossier", "program venue to confirm", "program-specific venue to confirm", "venue to confirm",
    "specific residence format not yet confirmed", "institutional lead",
)
RESIDENTIAL_PHRASES = (
    "live in residence halls", "residence halls", "housing and meals", "students stay in university dormitories", "campers stay in dorms", "residential program", "residential camp",
    "residential college preparatory program", "four-week summer residential program", "dormitories", "dorms", "boarding", "campus life firsthand",
)
OVERNIGHT_PATTERN = r"(?i)\b(?:overnight|sleepaway|residential|cabin|cabins|dormitory|dorm|bunk|bunks|lodge|lodging|sleep-away|boarding|campers\s+stay)\b"
SESSION_MODELS = (
    ("multiple_sessions", ("varies", "multiple", "session length varies")), ("weekly", ("1 week", "one week", "7 days", "8 days")), ("two_week", ("2 week", "two week", "14 days")), ("three_week", ("3 week", "three week", "21 days")),
    ("month", ("4 week", "four week", "28 days", "~27 days", "month")), ("six_week", ("6 week", "six week", "42 days")), ("course_based", ("boarding", "course-based")),
)
EMPTY_DURATIONS = (
    "unknown", "not applicable", "session length not extracted in this pass", "session length varies", "residential college preparatory experience", "boarding summer program",
    "summer program length not captured in this pass",
)
AUDIENCE_AGES = {
    "elementary": (5, 11), "middle-school": (11, 14), "high-school": (14, 18), "elementary-middle-school": (5, 14), "middle-school-high-school": (11, 18), "elementary-middle-school-high-school": (5, 18), "gifted-middle-school": (11, 14),
}
ORDINAL_GRADES_PATTERN = r"(?i)(\d{1,2})(?:st|nd|rd|th)?[-\s]+(?:and\s+)?(\d{1,2})(?:st|nd|rd|th)?[-\s]*grade"
SENIOR_PATTERN = r"(?i)rising\s+senior|entering\s+(?:their\s+)?senior\s+year"
JUNIOR_SENIOR_PATTERN = r"(?i)entering\s+(?:their\s+)?junior\s+or\s+senior\s+year"
NINE_TO_TWELVE_PATTERN = r"(?i)(?:9|9th).*(?:12|12th)\s*grade"
TENTH_ELEVENTH_PATTERN = r"(?i)finishing\s+10th\s+or\s+11th\s+grade"
STANDARD_FAMILIES = (
    "college-pre-college", "academic", "stem", "sports", "arts", "music", "wilderness", "faith-based", "family", "adventure", "leadership", "humanities", "science", "engineering", "research", "computing", "math", "debate", "gifted-talented",
)
STANDARD_TYPES = ("overnight", "residential", "residential-academic", "retreat", "research-program", "program-dependent")
FUNDED_PHRASES = ("fully funded", "scholarship")
PHASE1_BOARDING_WORDS = ("all-inclusive", "including", "includes", "boarding", "accommodation", "meals", "housing", "lodging")
DEFAULT_EXPANSIONS = ("{seed}", "{seed} overnight camp", "{seed} residential summer camp", "{seed} youth overnight program")
FAMILY_EXPANSIONS = {
    "college-pre-college": ("{seed} pre-college residential program", "{seed} summer residential high school program", "{seed} on-campus summer program for high school students"),
    "sports": ("{seed} overnight sports camp", "{seed} residential athletic camp"), "arts": ("{seed} residential arts camp",), "music": ("{seed} residential music camp", "{seed} band camp overnight"),
    "faith-based": ("{seed} youth retreat overnight", "{seed} faith-based summer camp residential"), "family": ("{seed} family camp lodging",),
}
IGNORED_SCOPE = ("", "all", "any", "multi", "na", "n/a", "national", "nationwide", "unk", "unknown")
GUARD_REASON = "Held back: strong signs of a stay overnight speak against this verdict."
GUARD_SIGNAL = "guardrail: strong overnight signs"
#: (country, region or null for the rest of the country) -> language mode and query angles.
REGION_TEMPLATES = (
    ("US", None, "english-first; keep Spanish and French evidence when encountered", ('"overnight summer camp" "{region}"', '"residential summer camp" "{region}"', '"family camp" "{region}"', '"youth retreat" "{region}" overnight', 'site:.edu "{region}" "pre-college" residential')),
    ("CA", "QC", "french-first; keep English evidence when encountered", ('"camp de vacances" "{region}"', '"camp residentiel" "{region}"', '"camp avec hebergement" "{region}"', '"camp familial" "{region}"', 'site:.ca "{region}" programme residentiel secondaire')),
    ("CA", "NB", "bilingual English/French; preserve whichever language the source uses", ('"overnight camp" "{region}"', '"camp de vacances" "{region}"', '"camp with accommodation" "{region}"', '"camp residentiel" "{region}"', 'site:.ca "{region}" "pre-college" residential')),
    ("CA", None, "english-first; keep French evidence when encountered", ('"overnight camp" "{region}"', '"residential camp" "{region}"', '"camp with accommodation" "{region}"', '"family camp" "{region}"', 'site:.ca "{region}" "pre-college" residential')),
    ("MX", None, "spanish-first; keep English evidence when encountered", ('"campamento de verano con alojamiento" "{region}"', '"campamento residencial" "{region}"', '"campamento juvenil" "{region}"', '"retiro juvenil" "{region}" hospedaje', 'site:.mx "{region}" programa residencial preuniversitario')),
)
BOARDING_PHRASES = ("housing and meals included", "housing included", "board included", "live on campus", "reside in")
CURRENCY_BY_COUNTRY = {"US": "USD", "CA": "CAD", "MX": "MXN"}
ACTIVITY_MONTHS = 24
STATUS_RANK = {"missing": 0, "uncertain": 1, "partial": 2, "found": 3}


@dataclass(frozen=True)
class TagRules:
    """Ordered (needle, tag) pairs; a text without any gets ``default``. ``whole_words`` demands word boundaries."""

    pairs: tuple[tuple[str, str], ...]
    default: str | None = None
    whole_words: bool = False


FAMILIES = TagRules(FAMILY_RULES, "unspecified")
CAMP_TYPES = TagRules(CAMP_TYPE_RULES, "unknown")


def tag_rules(rows, default: str | None = None, whole_words: bool = False) -> TagRules:
    """A pack from a small table with columns position, needle and tag. (UDF-02)"""
    ordered = rows.orderBy("position").select("needle", "tag").collect()  # a vocabulary, not data
    return TagRules(tuple((r.needle, r.tag) for r in ordered), default, whole_words)
