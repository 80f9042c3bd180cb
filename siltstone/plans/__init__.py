"""The warehouse: layers, views, reports and source preparation."""
