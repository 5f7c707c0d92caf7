from macroloom.plans import align, bulk, outlook, reserves, reserves_feeds, translate, vocabulary

__all__ = ["align", "bulk", "outlook", "reserves", "reserves_feeds", "translate", "vocabulary"]
