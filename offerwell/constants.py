"""Fixed values that must equal the original system's for right results."""

EUR_TO_MAD = 10.85

FINAL_COLUMNS = [
    "id", "source", "title_clean", "price_initial", "price_offre", "currency",
    "price_initial_mad", "price_offre_mad", "eur_to_mad_rate", "discount_pct", "seller", "location",
    "category", "rating", "date", "link", "offre_type", "is_duplicate",
]

# Category keyword lists, first list wins.
HIGH_VALUE_WORDS = [
    "smartphone", "téléphone", "phone", "tablette", "tablet", "laptop", "ordinateur", "tv", "vidéo", "photo",
    "électroménager",
]
ACCESSORY_WORDS = [
    "accessoire", "audio", "écouteur", "casque", "câble", "cable", "coque", "étui", "mouse", "souris", "clavier",
    "keyboard", "gaming",
]
# Shorter lists of the offer suggestion.
SUGGEST_HIGH_VALUE_WORDS = ["phone", "tablet", "laptop", "tv", "electromenager"]
SUGGEST_ACCESSORY_WORDS = ["accessoire", "audio", "cable", "coque", "souris", "casque"]

# source: base, alpha (log price), beta (rating), tau (rating target), delta, kappa, low, high
PRICING_PARAMS = {
    "Amazon": (8.0, 3.0, 2.0, 4.5, 0.0, 10.0, 5.0, 40.0),
    "Jumia": (12.0, 4.0, 3.0, 4.0, 0.0, 10.0, 10.0, 50.0),
    "CDiscount": (15.0, 5.0, 4.0, 5.0, 0.0, 10.0, 10.0, 60.0),
    "Steam": (20.0, 0.0, 5.0, 5.0, 1000.0, 10.0, 10.0, 85.0),
    "Avito": (5.0, 0.5, 1.5, 4.0, 0.0, 10.0, 0.0, 20.0),
}
DEFAULT_PARAMS = (10.0, 3.0, 2.0, 5.0, 0.0, 10.0, 5.0, 50.0)

CATEGORY_GROUPS = {
    "Tech & Computing": ["Informatique"],
    "Mobile & Tablets": ["Smartphones", "Tablettes", "Téléphones & Tablettes"],
    "Home & Appliances": ["Maison", "Maison & Cuisine", "Électroménager"],
    "Entertainment": ["Gaming", "Jouets", "Jeux & Jouets"],
    "TV, Audio & Photo": ["TV & Vidéo", "TV & Home Cinéma", "Audio", "Photo & Caméra"],
    "Fashion & Accessories": ["Mode Femme", "Mode Homme", "Montres", "Accessoires"],
    "Beauty & Health": ["Beauté", "Beauté & Santé"],
    "Sports & Outdoors": ["Sport"],
    "Electronics (General)": ["Électronique"],
    "Steam Digital Store": ["Steam Specials", "Steam Top Sellers", "Steam Popular New", "Steam All Games"],
}

# Viewer categories found in links, first match wins, and category badges of the catalogue sources.
LINK_CATEGORIES = [
    ("appartements|maisons|villas|immobilier|riads", "🏠 Immobilier"),
    ("voitures", "🚗 Voitures"),
    ("smartphone|t.l.phone|iphone|samsung", "📱 Téléphones"),
    ("motos|velos|scooter", "🏍️ Motos"),
]
CATEGORY_ICONS = {
    "amazon": {
        "Smartphones": "📱", "Informatique": "💻", "Tablettes": "📱", "TV & Home Cinéma": "📺", "Audio": "🔊",
        "Jeux vidéo": "🎮", "Mode": "👗", "Maison": "🛋️", "Beauté": "💄", "Sport": "⚽", "Jouets": "🧸",
        "Cuisine": "🍳",
    },
    "jumia": {
        "Téléphones & Tablettes": "📱", "Informatique": "💻", "Électronique": "🔌", "Électroménager": "🏠",
        "Mode Homme": "👔", "Mode Femme": "👗", "Beauté & Santé": "💄", "Sport & Loisir": "⚽",
        "Jeux & Jouets": "🎮", "Maison & Cuisine": "🛋️", "Accessoires": "⌚",
    },
}
DEFAULT_ICON = "📦"

BLOCK_MARKERS = [
    "validatecaptcha", "ap-captcha", "captchacharacters", "type the characters", "enter the characters",
    "verify you are human", "unusual traffic", "automated access", "auth-workflow", "javascript is disabled",
    "enable javascript",
]
SKIP_LINK_WORDS = [
    "/search/", "/recherche", "guides-d-achat", "/magasin", "/avis-clients", "/aide", "/info-", "cdiscount.fr/mag",
    "account.", "partner.", "tracking.", "/nav/", "javascript:",
]
GENERIC_TITLES = ["cdiscount", "logo", "image", "menu", "accueil", "retour"]
PROFILE_KEYWORDS = ["ProductCard", "DealCard", "GridItem", "deal-card", "s-search-result", "grid-card"]

# Negotiation: input memberships (corner points), output terms, rules.
FUZZY_INPUTS = {
    ("gap", "small"): (0.0, 0.0, 8.0, 15.0),
    ("gap", "medium"): (10.0, 20.0, 20.0, 35.0),
    ("gap", "large"): (30.0, 45.0, 100.0, 100.0),
    ("progress", "early"): (0.0, 0.0, 0.2, 0.4),
    ("progress", "middle"): (0.3, 0.5, 0.5, 0.7),
    ("progress", "late"): (0.6, 0.8, 1.0, 1.0),
    ("trend", "falling"): (-1.0, -1.0, -0.1, 0.0),
    ("trend", "stable"): (-0.05, 0.0, 0.0, 0.05),
    ("trend", "rising"): (0.0, 0.1, 1.0, 1.0),
}
# Output terms over the concession rate, in thousandths (grid of 501 points on 0..0.5).
FUZZY_OUTPUTS = {
    "none": (0, 0, 20, 50),
    "weak": (30, 80, 80, 150),
    "normal": (120, 220, 220, 320),
    "strong": (280, 380, 500, 500),
}
FUZZY_RULES = [
    ((("gap", "large"), ("trend", "falling")), "none"),
    ((("gap", "large"), ("trend", "stable")), "weak"),
    ((("gap", "large"), ("trend", "rising")), "weak"),
    ((("gap", "medium"), ("trend", "falling")), "weak"),
    ((("gap", "medium"), ("trend", "stable")), "normal"),
    ((("gap", "medium"), ("trend", "rising")), "normal"),
    ((("gap", "small"), ("trend", "falling")), "normal"),
    ((("gap", "small"), ("trend", "stable")), "strong"),
    ((("gap", "small"), ("trend", "rising")), "strong"),
    ((("progress", "late"),), "strong"),
    ((("progress", "early"), ("gap", "large")), "none"),
    ((("progress", "middle"), ("gap", "medium")), "normal"),
    ((("progress", "early"), ("gap", "small")), "strong"),
]
DEFAULT_RATE = 0.05
PRICE_EPSILON = 0.05
MAX_ROUNDS = 5
