"""Human-readable byte sizes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Binary size units in ascending order.
UNITS = ("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB")


def readable_size(n_bytes: Column) -> Column:
    """Bytes as text such as ``1.50 MiB``."""
    text = None
    for power in reversed(range(len(UNITS))):
        scaled = F.concat(
            F.format_string("%.2f", n_bytes / F.lit(float(1024**power))), F.lit(f" {UNITS[power]}")
        )
        if text is None:
            text = F.when(n_bytes >= 1024**power, scaled)
        elif power:
            text = text.when(n_bytes >= 1024**power, scaled)
        else:
            text = text.otherwise(scaled)
    return text
