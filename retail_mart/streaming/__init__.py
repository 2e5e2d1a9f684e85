"""High-watermark incremental processing.

The reference loads facts incrementally by a watermark: the last loaded
period is deleted and everything from it on is recomputed; rows dated before
the watermark are never picked up again (late-data policy, quirk Q13).
"""
