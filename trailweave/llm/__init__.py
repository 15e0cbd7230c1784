"""Training-data operators over tables of documents and pages; nothing else in the library imports this package."""
