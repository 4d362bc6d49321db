"""Fine-tuning data preparation and completion scoring as Spark DataFrame operators."""
