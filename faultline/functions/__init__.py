from faultline.functions import hashing, numeric, risk, text

__all__ = ["hashing", "numeric", "risk", "text"]
