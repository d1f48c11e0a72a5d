from lacuna.functions import codes, hashing, timing

__all__ = ["codes", "hashing", "timing"]
