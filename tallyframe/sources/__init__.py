"""Reading, staging and writing of frames."""
