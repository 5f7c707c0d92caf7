from macroloom.functions import dates, labels, numbers, text

__all__ = ["dates", "labels", "numbers", "text"]
