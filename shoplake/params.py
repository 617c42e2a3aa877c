"""Fixed values of the event model and its jobs."""

from decimal import Decimal

# Columns that identify one event.
DEDUP_KEY = ("event_time", "user_id", "product_id", "event_type")

# Validation rules; price bounds are inclusive.
PRICE_MIN = Decimal("0.01")
PRICE_MAX = Decimal("1000000.00")
EVENT_TYPES = ("view", "cart", "purchase", "remove_from_cart")
UNKNOWN = "unknown"

# Parsing and streaming.
# Seconds may have a fraction; written times always do.
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
TIMEZONE = "UTC"
WATERMARK = "5 minutes"
# Silence that ends a visit of a session.
SESSION_GAP = "30 minutes"
MAX_OFFSETS_PER_TRIGGER = 100_000

# Interaction scores: weight per event type, decayed per day.
DECAY_PER_DAY = 0.02
ALS_VIEW_WEIGHT = 1.0
ALS_ACTION_WEIGHTS = {"cart": 10.0, "purchase": 100.0, "remove_from_cart": -10.0}
ALS_VIEW_CAP = 50.0

# Implicit-feedback recommender.
ALS_RANK = 150
ALS_ITERATIONS = 15
ALS_REGULARIZATION = 0.01
ALS_ALPHA = 150.0
ALS_BLOCK_FACTOR = 2
# Iterations between checkpoints: an iteration's shuffle files go when its factors are stored.
ALS_CHECKPOINT_EVERY = 1
TOP_K = 10
SEED = 36
TRAIN_SHARE = 0.8

# Popularity lists for cold starts.
POPULAR_WEIGHTS = {"purchase": 3.0, "cart": 10.0, "remove_from_cart": -10.0, "view": 1.0}
POPULAR_TOP_K = 100
POPULAR_PER_CATEGORY = 20

# Purchase-intent classifier.
CLASS_WEIGHTS = {"view": 1.0, "cart": 7.0, "purchase": 15.0, "remove_from_cart": 3.5}
MIN_SAMPLE_WEIGHT = 0.01
RF_TREES = 128
RF_DEPTH = 10
RF_MIN_INSTANCES = 25
RF_MAX_BINS = 512
RF_SUBSAMPLING = 0.8
RF_FEATURE_STRATEGY = "auto"
TOP_N_CATEGORIES = 500
EXTRA_BINS = 10
PRECISION_K = 1000

# Upper edges of the price buckets, with the label of each bucket.
PRICE_BUCKETS = ((10, "0-10$"), (50, "11-50$"), (200, "51-200$"))
PRICE_BUCKET_TOP = ">200$"
