"""Fixed values of the domain. All of them are data that results depend on."""

# --- fixed values: category name -> marketplace category id, catalogue order ---
CATEGORY_IDS = {
    "Electronics": "58058",
    "Home & Garden": "11700",
    "Clothing & Accessories": "11450",
    "Sporting Goods": "888",
    "Toys & Hobbies": "220",
    "Health & Beauty": "26395",
    "Pet Supplies": "1281",
    "Automotive Parts": "6000",
    "Musical Instruments": "619",
    "Collectibles": "1",
}

# --- fixed values: category name -> searched keywords ---
SEARCH_KEYWORDS = {
    "Electronics": ["consumer electronics", "gadgets online"],
    "Home & Garden": ["home decor", "garden supplies"],
    "Clothing & Accessories": ["online clothing", "fashion accessories"],
    "Sporting Goods": ["sports equipment", "fitness gear"],
    "Toys & Hobbies": ["toys online", "hobby supplies"],
    "Health & Beauty": ["health products", "beauty supplies"],
    "Pet Supplies": ["pet products", "pet accessories"],
    "Automotive Parts": ["auto parts online", "car accessories"],
    "Musical Instruments": ["musical instruments", "guitar accessories"],
    "Collectibles": ["collectibles buy", "rare items online"],
}

# --- fixed values: communities searched for posts ---
COMMUNITIES = ["flipping", "entrepreneur", "ecommerce", "amazonseller", "Ebay", "dropship"]

# --- fixed values: category name -> term searched in each community ---
COMMUNITY_TERMS = {
    "Electronics": "electronics",
    "Home & Garden": "home garden",
    "Clothing & Accessories": "clothing fashion",
    "Sporting Goods": "sporting goods fitness",
    "Toys & Hobbies": "toys hobbies",
    "Health & Beauty": "health beauty",
    "Pet Supplies": "pet supplies",
    "Automotive Parts": "auto parts car",
    "Musical Instruments": "musical instruments",
    "Collectibles": "collectibles vintage",
}

# --- fixed values: expenditure label -> category name (other labels pass through) ---
SPEND_LABELS = {
    "Apparel and services": "Clothing & Accessories",
    "Entertainment": "Toys & Hobbies",
    "Personal care products": "Health & Beauty",
    "Household furnishings & equipment": "Home & Garden",
    "Vehicles": "Automotive Parts",
    "Pets, toys, hobbies": "Pet Supplies",
    "Reading": "Collectibles",
    "Sports & recreation equipment": "Sporting Goods",
}

# --- fixed values: category name -> base online share ---
BASE_ONLINE_SHARE = {
    "Electronics": "0.62",
    "Clothing & Accessories": "0.38",
    "Home & Garden": "0.33",
    "Health & Beauty": "0.42",
    "Toys & Hobbies": "0.51",
    "Pet Supplies": "0.28",
    "Sporting Goods": "0.30",
    "Automotive Parts": "0.22",
    "Musical Instruments": "0.45",
    "Collectibles": "0.70",
}

# --- fixed values: weight of each component in the opportunity score, in summing order ---
SCORE_WEIGHTS = {
    "trend_score": 0.25,
    "buzz_score": 0.20,
    "demand_score": 0.30,
    "spend_score": 0.15,
    "competition_score": 0.10,
}

# --- fixed values: source tags ---
MARKETPLACE = "ebay"
RANKED_LISTS = "amazon_bsr"
DERIVED = "derived"

CATEGORIES = list(CATEGORY_IDS)
