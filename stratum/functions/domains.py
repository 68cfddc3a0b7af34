"""Domain values of the shop data model.

FIXED VALUES: these must equal the source application's choices for the
results to agree; they are stated plainly, in their natural order.
"""

# --- fixed values -----------------------------------------------------------
ORDER_STATUSES = ["pending", "processing", "completed", "cancelled"]
EVENT_TYPES = ["page_view", "product_view", "search", "add_to_cart",
               "remove_from_cart", "checkout", "purchase", "click"]
SUBSCRIPTION_STATUSES = ["trial", "active", "cancelled", "expired"]
BILLING_CYCLES = ["monthly", "yearly"]
INVOICE_STATUSES = ["draft", "sent", "paid", "overdue", "cancelled"]
SIGNUP_SOURCES = ["organic", "paid_ad", "referral", "social"]
PLAN_FEATURES = {
    "enterprise": ["analytics", "api_access", "custom_domain", "priority_support", "sso"],
    "professional": ["analytics", "api_access", "custom_domain"],
    "starter": ["analytics"],
}
TAX_RATE = "0.08"            # order tax applied when rolling items up
INVOICE_PERIOD_DAYS = 30
PRODUCT_MIN_PRICE = "0.01"
LOW_STOCK_THRESHOLD = 50
# --- end fixed values -------------------------------------------------------

# Fixture mapping of the driver's event vocabulary onto the shop's.
DRIVER_EVENT_MAP = {
    "view": "page_view",
    "click": "product_view",
    "signup": "add_to_cart",
    "error": "checkout",
    "purchase": "purchase",
}

# Subscription plans used by the fixtures: (name, monthly amount).
SUBSCRIPTION_PLANS = [("Basic", "9.99"), ("Pro", "29.99"),
                      ("Premium", "99.99"), ("Enterprise", "299.99")]

# Funnel steps (ours) and engagement weights (ours).
FUNNEL_STEPS = ["page_view", "product_view", "add_to_cart", "checkout", "purchase"]
ENGAGEMENT_WEIGHTS = {"page_view": 1, "product_view": 2, "search": 1, "click": 1,
                      "add_to_cart": 5, "remove_from_cart": 0, "checkout": 8,
                      "purchase": 10}

# Allowed order status transitions (ours): forward along the pipeline,
# any open state may be cancelled, and a status may repeat.
ORDER_TRANSITIONS = [("pending", "processing"), ("processing", "completed"),
                     ("pending", "completed"), ("pending", "cancelled"),
                     ("processing", "cancelled")]
