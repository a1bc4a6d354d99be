"""Attribution of activity records to places and products, as Spark DataFrame operators."""
