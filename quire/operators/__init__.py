from quire.operators.clean import clean_reviews  # noqa: F401
from quire.operators.keyed import latest_per_key  # noqa: F401
from quire.operators.marts import (  # noqa: F401
    customer_stats, customers_by_period, items_by_period, monthly_product_reviews,
    product_stats, review_projection, sentiment_by_period,
)
from quire.operators.messages import (  # noqa: F401
    archive_rows, decode_messages, decode_processed, encode_rows, filter_pages,
    publish_rows, sse_to_messages, stamp_messages, wiki_filter,
)
from quire.operators.profile import (  # noqa: F401
    observed, profile, review_stage_counts,
)
from quire.operators.serving import (  # noqa: F401
    newest_pages, reviews_of_customer, reviews_of_product, top_backers, top_customers,
    top_haters, top_n_per_group, top_products, top_products_all_periods,
)
