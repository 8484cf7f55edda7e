"""Table contracts in this engine's typing (ids are numbers here, so the
source's id-prefix patterns do not apply).

Declared is not run: the queries run the whole contract of ``transactions``
only, and single rules of ``clickstreams``, ``promotions`` and ``customers``."""

SEGMENTS = ["New Customers", "Active Customers", "Churn Risk Customers", "High Spenders", "Budget Shoppers"]

# Accepted values, key declarations and ranges of the contracts.
CONTRACTS = {
    "customers": {
        "pk": ["customer_id"],
        "unique_columns": ["email"],
        "required": ["customer_id", "customer_type"],
        "regex": {"email": r"^[^@]+@[^@]+\.[^@]+$"},
        "types": {"customer_id": "int", "customer_type": "string", "email": "string", "area": "string",
                  "region": "string", "loyalty_points": "int", "customer_segment": "string",
                  "email_marketing_opt_in": "bool", "sms_marketing_opt_in": "bool",
                  "push_notifications_opt_in": "bool"},
        "date_columns": ["dob", "signup_date"],
        "accepted_values": {"customer_type": ["Retail Walk-In", "Retail Members", "Online Only", "Omnichannel"],
                            "gender": ["Female", "Male"], "customer_segment": SEGMENTS,
                            "device_category": ["Mobile", "Desktop", "Tablet"],
                            "device_platform": ["iOS", "Android", "Web"]},
        "ranges": {"loyalty_points": (0, None)},
    },
    "stores": {"pk": ["store_id"], "required": ["store_id", "area", "region"],
               "accepted_values": {"store_type": ["Online", "Flagship", "Mall", "Neighbourhood"]}},
    "products": {"pk": ["product_id"], "required": ["product_id", "product_name", "category", "selling_price", "cost_price"],
                 "ranges": {"selling_price": (0, None), "cost_price": (0, None)}},
    "transactions": {
        "pk": ["transaction_id"],
        "unique_combinations": [["customer_id", "store_id", "transaction_time"]],
        "required": ["transaction_id", "customer_id", "store_id", "transaction_time", "transaction_total", "payment_method"],
        "fk": {"customer_id": ("customers", "customer_id"), "store_id": ("stores", "store_id")},
        "types": {"transaction_id": "int", "customer_id": "int", "store_id": "int", "transaction_total": "float",
                  "payment_method": "string"},
        "datetime_columns": ["transaction_time"],
        "accepted_values": {"payment_method": ["Credit Card", "Debit Card", "Digital Wallet", "Buy Now Pay Later", "Cash"]},
        "ranges": {"cart_subtotal": (0, None), "total_discount": (0, None), "shipping_fee": (0, None),
                   "shipping_discount": (0, None), "transaction_total": (0, None), "basket_size": (1, None),
                   "num_unique_items": (1, None)},
    },
    "transaction_items": {
        "unique_combinations": [["transaction_id", "product_id"]],
        "required": ["transaction_id", "product_id", "quantity", "unit_price", "item_subtotal"],
        "fk": {"transaction_id": ("transactions", "transaction_id"), "product_id": ("products", "product_id")},
        "ranges": {"quantity": (1, None), "unit_price": (0, None), "item_subtotal": (0, None),
                   "item_discount": (0, None), "final_item_price": (0, None)},
    },
    "promotions": {
        "pk": ["promotion_id"],
        "required": ["promotion_id", "promotion_scope", "promotion_mechanic"],
        "date_columns": ["effective_start_date", "effective_end_date"],
        "accepted_values": {"promotion_mechanic": ["percentage_discount", "dollar_discount", "free_shipping", "bundle"],
                            "promotion_scope": ["cart", "category", "product", "bundle"]},
        "ranges": {"promotion_value": (0, None), "min_spend": (0, None), "priority": (1, 4)},
    },
    "clickstreams": {
        "required": ["event_id", "session_id", "customer_id", "event_type", "event_timestamp"],
        "fk": {"customer_id": ("customers", "customer_id"), "product_id": ("products", "product_id")},
        "types": {"event_id": "int", "session_id": "string", "customer_id": "int", "event_type": "string",
                  "product_id": "int", "scroll_depth": "int"},
        "datetime_columns": ["event_timestamp"],
        "accepted_values": {"event_type": ["Home View", "Category View", "Search View", "Product View", "Cart View",
                                           "Add to Cart", "Remove from Cart", "Checkout Start", "Payment Attempt",
                                           "Payment Successful", "Payment Failed"]},
        "ranges": {"event_order": (1, None), "scroll_depth": (0, 100), "bounce_flag": (0, 1), "cart_size": (0, None)},
    },
    "campaign_exposures": {
        "unique_combinations": [["customer_id", "campaign_id", "channel", "exposed_time"]],
        "fk": {"customer_id": ("customers", "customer_id"), "campaign_id": ("campaigns", "campaign_id")},
        "datetime_columns": ["exposed_time", "opened_time", "clicked_time"],
        "accepted_values": {"assignment_group": ["Treatment", "Control"], "device_platform": ["iOS", "Android", "Web"]},
        "ranges": {"cost_per_msg": (0, None)},
    },
    "bundle_pricings": {
        "pk": ["bundle_pricing_id"], "unique_combinations": [["bundle_id", "effective_start_date"]],
        "date_columns": ["effective_start_date", "effective_end_date"],
        "accepted_values": {"pricing_phase": ["LAUNCH", "EOL", "PROMO"]},
        "ranges": {"bundle_price": (0, None), "discount_value": (0, None)},
    },
    "inventory_change_events": {
        "unique_combinations": [["store_id", "product_id", "event_timestamp"]],
        "fk": {"store_id": ("stores", "store_id"), "product_id": ("products", "product_id")},
        "datetime_columns": ["event_timestamp"], "ranges": {"stock_after": (0, None)},
    },
    "stockout_events": {
        "unique_combinations": [["store_id", "product_id", "stockout_start_date"]],
        "fk": {"store_id": ("stores", "store_id"), "product_id": ("products", "product_id")},
        "date_columns": ["stockout_start_date", "stockout_end_date"],
    },
    "store_catalogues": {
        "unique_combinations": [["store_id", "product_id"]],
        "fk": {"store_id": ("stores", "store_id"), "product_id": ("products", "product_id")},
        "ranges": {"store_selling_price": (0, None)},
    },
    "bundle_items": {"unique_combinations": [["bundle_id", "product_id"]],
                     "fk": {"product_id": ("products", "product_id")}, "ranges": {"quantity": (1, None)}},
    "product_reviews": {"pk": ["review_id"], "unique_combinations": [["transaction_id", "product_id"]],
                        "fk": {"product_id": ("products", "product_id")}, "date_columns": ["review_date"],
                        "ranges": {"rating": (1, 5)}},
    "product_content_quality": {
        "pk": ["content_version_id"], "unique_combinations": [["product_id", "valid_from"]],
        "fk": {"product_id": ("products", "product_id")}, "date_columns": ["valid_from", "valid_to"],
        "accepted_values": {"quality_tier": ["Poor", "Average", "Good", "Excellent"]},
        "ranges": {"image_count": (0, None), "image_quality_score": (0, 1), "description_length": (0, None),
                   "missing_attribute_count": (0, None)},
    },
}
