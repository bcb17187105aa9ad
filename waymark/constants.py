"""Fixed values.

These must equal the values the original travel planner uses for its results to
match; they are stated here once, in plain form, and passed as parameters
everywhere else.
"""

# --- fixed values -----------------------------------------------------------
PRICE_MAX_POINTS = 70          # weight of the price part of a hotel score
REVIEW_MAX_POINTS = 30         # weight of the review part of a hotel score
STAY_NIGHTS = 7                # nights requested per hotel search
PRICE_DIVISOR_NIGHTS = 4       # divisor the original applies to the total price
DAYS_AHEAD = 4                 # length of the look-ahead window, in days
REQUEST_DAYS = 3               # days requested per round: ref+1 .. ref+3
TOP_K = 3                      # hotels kept per city and day
CURRENCY = "EUR"               # only offers in this currency are scored
BEST_BUCKET = "Best"           # itinerary bucket that holds the chosen flight
ORIGIN_CITY = "Vienna"         # every flight departs here
HOME_COUNTRY = "Austria"       # trips to this country need no flight
CSV_SEPARATOR = ";"            # catalogue files are ';' separated
CSV_DECIMAL = ","              # catalogue files use a decimal comma
# country names used by the monument catalogue for a catalogue country (opt-in, quirk Q13)
COUNTRY_ALIASES = {
    "United Kingdom": ["England", "Scotland", "Wales", "North Ireland"],
}
# ---------------------------------------------------------------------------
