"""Sky-catalog combination and data-preparation engine on PySpark."""
