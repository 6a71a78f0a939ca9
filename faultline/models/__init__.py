from faultline.models import calibrate, features, importance, score, train

__all__ = ["calibrate", "features", "importance", "score", "train"]
