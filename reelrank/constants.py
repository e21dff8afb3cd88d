"""Fixed values that must equal the reference's for identical results."""

# --- fixed values (reference parameters) -------------------------------------------------
# The 20 genre names, in the reference's order.
GENRES = (
    "Action", "Adventure", "Animation", "Comedy", "Crime", "Documentary", "Drama", "Family",
    "Fantasy", "Foreign", "History", "Horror", "Music", "Mystery", "Romance", "Science",
    "Tv", "Thriller", "War", "Western",
)
GENRE_TOP_K = 10            # best titles kept per genre
USER_TOP_K = 20             # recommendations kept per user (offline ALS)
ALS_RANK, ALS_ITERATIONS, ALS_REG = 200, 5, 0.1
ALS_GRID_RANKS = (20, 50, 100, 200, 300)
ALS_GRID_REGS = (0.001, 0.01, 0.1)
ALS_GRID_ITERATIONS = 5
TRAIN_FRACTION = 0.8
ITEM_SIM_THRESHOLD = 0.6    # stored similarity lists keep sim > 0.6
RERANK_SIM_THRESHOLD = 0.7  # streaming re-rank keeps sim > 0.7
LIKE_THRESHOLD = 3.0        # a recent rating > 3 boosts, <= 3 penalises
STREAM_CANDIDATES_K = 20    # unseen similar movies considered per event
RECENT_K = 21               # recent ratings per user (list range 0..20 is inclusive)
CONTENT_FEATURES = 20       # hashed term-frequency width
MOVIE_SEP, RATING_SEP, TAG_SEP, MESSAGE_SEP, RECENT_ITEM_SEP = "^", ",", ",", "|", ":"
STREAM_INTERVAL = "2 seconds"
# -------------------------------------------------------------------------------------------

DEFAULT_SEED = 42
# Content neighbours listed per movie: a documented limit, as movies of the same genres are all similar;
# ``content_signatures`` holds everything. Item lists are whole unless a limit is asked for.
STORED_NEIGHBOURS = 100
# ALS user/item blocks. Factors are initialised block by block, so the count is part of the model:
# it is fixed here (pass another for a larger cluster) and never derived from the machine.
ALS_BLOCKS = 16
